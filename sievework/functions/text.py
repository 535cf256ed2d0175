"""Text expressions on samples: normal forms, fences, placeholders, code features. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PENDING = "[PENDING_DESCRIPTION]"
FENCES = ("prefix", "between", "regex", "slice")
PROMPTS = ("{d}", "Create a Manim animation that {l}", "Write Manim code to {l}", "Generate a Manim scene that {l}", "Implement a Manim animation for: {d}", "Using Manim, {l}")
_CALLS = (*(rf"{c}\(" for c in "Circle Square Rectangle Line Arrow Text MathTex VGroup".split()), r"(Cube|Cylinder|Sphere|Surface)\(", *(rf"{c}\(" for c in ("Triangle", "Polygon", "Dot")))
ELEMENTS = dict(zip("circles squares rectangles lines arrows text equations groups 3d_objects triangles polygons dots".split(), _CALLS, strict=True))
LEGACY_ELEMENTS = tuple(ELEMENTS)[:9]


def collapse(text: Column) -> Column:
    """White space runs as one space, none at the ends; Unicode white space counts."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def normalize_description(text: Column) -> Column:
    return collapse(F.lower(text))


def normalize_code(text: Column) -> Column:
    """Lines cut at the first #, white space collapsed, blank lines dropped. It is the dedup key's text."""
    lines = F.transform(F.split(text, "\n"), lambda line: collapse(F.substring_index(line, "#", 1)))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def token_set(text: Column) -> Column:
    """Sorted distinct white-space tokens; an empty text has none."""
    return F.array_sort(F.array_distinct(F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")))


def content_hash(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def strip_fence(text: Column, style: str = "prefix") -> Column:
    """Take code out of a Markdown fence; the styles differ where the closing fence is missing.

    prefix: an opening mark of nine characters and a closing one of three go, each if it is there.
    between: what stands between the opening mark and the next fence, else the text.
    regex: an opening line and a last closing line go. slice: nine characters and three go, unseen.
    """
    if style == "prefix":
        text = F.when(text.startswith("```python"), F.substr(text, F.lit(10))).otherwise(text)
        return strip(F.when(text.endswith("```"), F.left(text, F.greatest(F.length(text) - 3, F.lit(0)))).otherwise(text))
    if style == "between":
        inner = F.element_at(F.split(F.element_at(F.split(text, "```python"), 2), "```"), 1)
        return F.when(text.contains("```python"), strip(inner)).otherwise(text)
    if style == "regex":
        return F.regexp_replace(F.regexp_replace(text, r"\A```python\n", ""), r"\n```\z", "")
    if style == "slice":
        return F.substr(text, F.lit(10), F.greatest(F.length(text) - 12, F.lit(0)))
    raise ValueError(f"no fence style {style}; one of {FENCES}")


def ensure_import(code: Column) -> Column:
    """Prepend the star import where the word import stands nowhere."""
    code = strip(code)
    return F.when(code.contains("import"), code).otherwise(F.concat(F.lit("from manim import *\n\n"), code))


def ensure_scene(code: Column) -> Column:
    """Wrap code without a scene class in one, below its imports."""
    code = strip(code)
    lines = F.split(code, "\n")
    is_import = lambda line: F.trim(line).rlike("^(import |from )") & line.contains("manim")
    imports = F.filter(lines, is_import)
    rest = F.filter(lines, lambda line: ~is_import(line))
    head = F.when(F.size(imports) > 0, F.array_join(imports, "\n")).otherwise("from manim import *")
    body = F.array_join(F.transform(rest, lambda line: F.when(F.trim(line) != "", F.concat(F.lit("        "), line)).otherwise("")), "\n")
    wrapped = F.concat(head, F.lit("\n\nclass AnimationScene(Scene):\n    def construct(self):\n"), body, F.lit("\n"))
    parts = F.split(code, "\n\n", 2)
    below = F.filter(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), "\n"), lambda line: F.trim(line) != "")
    under = F.concat(F.get(parts, F.lit(0)), F.lit("\n\nclass AnimationScene(Scene):\n    def construct(self):\n        "), F.array_join(F.transform(below, lambda line: F.concat(F.lit("        "), line)), "\n"))
    has = code.contains("class") & code.contains("Scene")
    return F.when(has & code.contains("def construct"), code).when(~code.startswith("from manim import"), wrapped).when(~has, under).otherwise(code)


def augment_prompt(description: Column, variant: Column) -> Column:
    """The description in one of six prompt forms; the first letter in lower case where it runs on."""
    first = F.left(description, F.lit(1))
    low = F.when(F.upper(first) == first, F.concat(F.lower(first), F.substr(description, F.lit(2)))).otherwise(description)
    form = F.pmod(variant, F.lit(len(PROMPTS)))
    out = None
    for i, prompt in enumerate(PROMPTS):
        text = F.concat(F.lit(prompt[:-3]), description if prompt.endswith("{d}") else low)
        out = F.when(form == i, text) if out is None else out.when(form == i, text)
    return out


def needs_description(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    upper = F.upper(text)
    return text.startswith(PENDING) | (F.length(text) < 20) | (text.contains("[") & text.contains("]")) | upper.contains("TODO") | upper.contains("PLACEHOLDER") | (F.trim(text) == "")


def code_features(code: Column) -> Column:
    """Struct of flags, and the visual elements in fixed order."""
    any_of = lambda *words: F.greatest(*(code.contains(w) for w in words), F.lit(False))
    elements = F.filter(F.array(*(F.when(code.rlike(p), F.lit(n)) for n, p in ELEMENTS.items())), lambda e: e.isNotNull())
    return F.struct(
        any_of("ThreeDScene", "ThreeDAxes", "Surface").alias("has_3d"),
        any_of("MathTex", "Tex(").alias("has_latex"),
        any_of("Axes", "NumberPlane", "Graph").alias("has_graphs"),
        code.contains("VoiceoverScene").alias("has_voiceover"),
        (F.lower(code).contains("binary") | code.contains("0b")).alias("has_binary_ops"),
        any_of("^", "XOR", "oplus").alias("has_xor"),
        code.contains(".animate").alias("has_animations"),
        elements.alias("visual_elements"),
    )


def fallback_description(features: Column) -> Column:
    shown = F.array_join(F.slice(features["visual_elements"], 1, 3), ", ")
    text = F.concat(F.lit("Create an animation that shows "), shown, F.when(features["has_3d"], " in 3D space").otherwise(""), F.when(features["has_latex"], " with mathematical equations").otherwise(""))
    return F.when(F.size(features["visual_elements"]) > 0, text).otherwise("Create a Manim animation for this concept")


def spoken_seconds(text: Column) -> Column:
    """Speaking time at 150 words a minute, bookmarks left out, between half a second and five."""
    bare = F.trim(F.regexp_replace(text, r"<bookmark[^>]*>", ""))
    words = F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"(?U)\s+")))
    return F.round(F.greatest(F.lit(0.5), F.least(F.lit(5.0), words * 60 / 150)), 1)


def camel_words(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"(?<!^)(?=[A-Z])", " "))


def error_bucket(message: Column) -> Column:
    """Kind of a render failure; the first that fits."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(m.contains("no module named") | m.contains("import"), "import_error")
        .when(m.contains("syntax"), "syntax_error")
        .when(m.contains("timeout"), "timeout")
        .when(m.contains("no video file") | m.contains("no png file"), "no_output")
        .when(m.contains("attributeerror"), "attribute_error")
        .when(m.contains("typeerror"), "type_error")
        .when(m.contains("nameerror"), "name_error")
        .otherwise("other")
    )


def cache_key(*parts: Column) -> Column:
    """SHA-256 of the parts as JSON."""
    return F.sha2(F.to_json(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts)))), 256)


def description_key(code: Column, metadata: Column) -> Column:
    """Cache key of a description: code and the four metadata fields (JSON text) that bear on it."""
    field = lambda name: F.get_json_object(metadata, f"$.{name}")
    return cache_key(code, field("original_context"), field("source"), field("video_title"), field("youtube_url"))


def training_text(turns: Column, family: str = "qwen", fence: bool = False, eos: str = "") -> Column:
    """Prompt and answer of a three-turn conversation as one training text, in the form of a model family.

    qwen: ChatML with its own end mark; llama: header marks; other families: plain labels. `eos` follows the last two.
    """
    system, user, answer = (F.get(turns, F.lit(i))["value"] for i in range(3))
    if fence:
        answer = F.when(answer.startswith("```python"), answer).otherwise(F.concat(F.lit("```python\n"), answer, F.lit("\n```")))
    if family == "qwen":
        forms = ("<|im_start|>system\n", "<|im_end|>\n<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n", "<|im_end|>")
    elif family == "llama":
        mark = "<|start_header_id|>{}<|end_header_id|>\n\n"
        forms = (mark.format("system"), "<|eot_id|>" + mark.format("user"), "<|eot_id|>" + mark.format("assistant"), eos)
    else:
        forms = ("System: ", "\n\nUser: ", "\n\nAssistant: ", eos)
    return F.concat(F.lit(forms[0]), system, F.lit(forms[1]), user, F.lit(forms[2]), answer, F.lit(forms[3]))


def chat_text(turns: Column, end: str = "<|im_end|>\n") -> Column:
    """Turns (`from`, value) in ChatML form; an unfenced answer gets a Python fence."""
    role = lambda t: F.when(t["from"] == "gpt", "assistant").otherwise(t["from"])
    value = lambda t: F.when((t["from"] == "assistant") & ~t["value"].contains("```"), F.concat(F.lit("```python\n"), t["value"], F.lit("\n```"))).otherwise(t["value"])
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|im_start|>"), role(t), F.lit("\n"), value(t), F.lit(end))), "")
