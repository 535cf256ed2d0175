"""Quality rules as columns: a struct (severity, rule, message) for each rule that a sample breaks, and the verdict."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.pycode import py_facts
from sievework.functions.text import PENDING

PLACEHOLDER_COMMENTS = r"(?im)#\s*(Your code here|Implementation goes here|Add your.*here|Fill in|Complete this)"
COMMANDS = r"self\.(play|add|wait|remove|bring_to_front|bring_to_back)\("
METHODS = ("play", "wait", "add", "remove", "move_to", "shift", "scale", "rotate", "set_color", "fade", "transform", "animate")
OBJECTS = tuple("Angle Annulus Arc Arrow Axes BraceBetweenPoints Circle ComplexPlane Cone CoordinateSystem Cube Cutout Cylinder Dodecahedron Dot Ellipse Graph Icosahedron ImplicitFunction Line Matrix NumberPlane Octahedron ParametricFunction PolarPlane Polygon Polyhedron Prism Pyramid Rectangle Sector Sphere Square StreamLines Table Tex Text Tree Triangle Vector YoungTableau".split())
_MORE = {"triangle": ("Polygon",), "vector": ("Arrow(",)}
_NAMED = lambda names: {n: (n, f"{n.title()}(", *_MORE.get(n, ())) for n in names.split()}
SHAPES = _NAMED("circle square triangle line arrow") | {"text": ("MathTex(", "Tex(", "Text("), "graph": ("plot", "NumberPlane(", "Axes(", "Graph(")} | _NAMED("matrix vector")
TEX_ESCAPE = r"""(MathTex|Text|Tex)\s*\(\s*["'][^"']*\\[^\\r][^"']*["']"""
GENERIC = ("Create a Manim animation", "Create an animation", "Manim scene")


def merged_config(config: Mapping[str, Any], source: str | None = None) -> dict[str, Any]:
    """Global settings, then the source's overrides (dictionaries merge one level), then the validation actions, which replace."""
    out = dict(config.get("global_settings", {}))
    for key, value in config.get("source_overrides", {}).get(source or "", {}).items():
        out[key] = out[key] | value if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    for key in ("allow_through", "must_reject"):
        if key in config.get("validation_actions", {}):
            out[key] = config["validation_actions"][key]
    return out


def basic(code: Column, description: Column) -> Column:
    """Enough code and description to look at."""
    return (F.length(F.coalesce(code, F.lit(""))) >= 20) & (F.length(F.coalesce(description, F.lit(""))) >= 5)


def code_only(code: Column) -> Column:
    """The looser rule of code-only sources."""
    return F.length(F.coalesce(code, F.lit(""))) > 20


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def _issue(severity: str, rule: str, message: str | Column) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def _gather(found: list[tuple[Column, Column]]) -> Column:
    return F.filter(F.array(*(F.when(broken, issue) for broken, issue in found)), lambda i: i.isNotNull())


def description_issues(description: Column) -> Column:
    d = F.coalesce(description, F.lit(""))
    blank = F.trim(d) == ""
    asks = ~blank & ~(d.startswith(PENDING) | d.startswith("[PLACEHOLDER"))
    generic = F.lit(False)
    for start in GENERIC:
        generic = generic | d.startswith(start)
    first = F.left(d, F.lit(1))
    return _gather(
        [
            (blank, _issue("CRITICAL", "V2", "description is empty")),
            (asks & d.rlike(r"(?i)\[(TODO|FIXME|INSERT|TBD|PLACEHOLDER)"), _issue("HIGH", "V4", "description holds a placeholder")),
            (asks & generic & (F.length(d) < 50), _issue("MEDIUM", "V5", "description is generic")),
            (asks & ~((F.upper(first) == first) & (F.lower(first) != first)), _issue("LOW", "V6", "no capital at the start")),
            (asks & ~F.rtrim(d).rlike(r"[.!?:]\z"), _issue("LOW", "V7", "no punctuation at the end")),
        ]
    )


def text_issues(description: Column, code: Column, config: Mapping[str, Any]) -> Column:
    """Rules on the code's text and on how it fits the description."""
    d, c = F.coalesce(description, F.lit("")), F.coalesce(code, F.lit(""))
    bare = F.regexp_replace(c, "(?m)#.*$", "")
    asked = not config.get("allow_through", {}).get("no_animation_methods", {}).get("enabled", False)
    low = F.lower(d)
    shape = F.coalesce(*(F.when(low.contains(name) & ~_any(c, signs), F.lit(name)) for name, signs in SHAPES.items()))
    placeholder = d.startswith(PENDING) | d.startswith("[PLACEHOLDER")
    return _gather(
        [
            (c.rlike(PLACEHOLDER_COMMENTS), _issue("HIGH", "V14", "placeholder comment")),
            (F.lit(asked) & ~bare.rlike(COMMANDS), _issue("CRITICAL", "V16", "no animation command")),
            (F.lit(asked) & ~_any(c, METHODS), _issue("MEDIUM", "V17", "no animation method")),
            (~_any(c, OBJECTS), _issue("MEDIUM", "V18", "no mathematical object")),
            (~placeholder & shape.isNotNull(), _issue("MEDIUM", "V19", F.concat(F.lit("description mentions "), shape))),
        ]
    )


def structure_issues(code: Column, facts: Column, config: Mapping[str, Any]) -> Column:
    """Rules on the syntax tree. Too little code or no tree ends the check; so does the lack of a scene."""
    c = F.coalesce(code, F.lit(""))
    rule = config.get("must_reject", {}).get("code_below_minimum", {})
    least = rule.get("min_length", 30) if rule.get("enabled", True) else 50
    short = F.length(c) < least
    parsed = ~short & facts["ok"]
    scene = parsed & (F.size(facts["scene_classes"]) > 0)
    names = lambda field: F.array_join(facts[field], ", ")
    one_by_one = F.concat(
        F.transform(F.when(scene, facts["missing_construct"]), lambda n: _issue("HIGH", "V12", F.concat(F.lit("no construct in "), n))),
        F.transform(F.when(scene, facts["empty_construct"]), lambda n: _issue("CRITICAL", "V13", F.concat(F.lit("empty construct in "), n))),
    )
    runs = config.get("check_executability", True)
    found = _gather(
        [
            (short, _issue("CRITICAL", "V8", "code too short")),
            (~short & ~facts["ok"], _issue("CRITICAL", "V9", F.concat(F.lit("syntax error: "), F.coalesce(facts["error"], F.lit(""))))),
            (parsed & ~facts["has_import"], _issue("HIGH", "V10", "no import")),
            (parsed & (F.size(facts["scene_classes"]) == 0), _issue("CRITICAL", "V11", "no scene class")),
            (facts["has_ellipsis"], _issue("HIGH", "V15", "placeholder ellipsis")),
            (F.lit(runs) & ~facts["ok"], _issue("CRITICAL", "V20", "code does not parse")),
            (F.lit(runs) & facts["ok"] & c.rlike(TEX_ESCAPE), _issue("MEDIUM", "V21", "suspicious escape in TeX")),
            (F.lit(runs) & (F.size(facts["undefined"]) > 0), _issue("MEDIUM", "V22", F.concat(F.lit("perhaps undefined: "), F.array_join(F.slice(facts["undefined"], 1, 5), ", ")))),
            (F.lit(runs) & facts["ok"] & c.contains("class") & c.contains("Scene") & ~facts["has_construct"], _issue("HIGH", "V23", "scene class without construct")),
        ]
    )
    return F.concat(found, F.coalesce(one_by_one, F.array().cast("array<struct<severity: string, rule: string, message: string>>")))


def passes(issues: Column, strict: bool = True) -> Column:
    bad = ("CRITICAL", "HIGH") if strict else ("CRITICAL",)
    return ~F.exists(issues, lambda i: i["severity"].isin(*bad))


def validate(samples: DataFrame, config: Mapping[str, Any] | None = None, source: str | None = None, strict: bool = True) -> DataFrame:
    """Add `issues`, their texts `issue_texts` and `is_valid`. Each code is parsed once."""
    config = merged_config(config or {}, source)
    code, description = F.col("code"), F.col("description")
    out = samples.withColumn("_facts", py_facts(code))
    issues = F.concat(description_issues(description), structure_issues(code, F.col("_facts"), config), text_issues(description, code, config))
    out = out.withColumn("issues", issues).drop("_facts")
    texts = F.transform("issues", lambda i: F.concat(F.lit("["), i["severity"], F.lit("] "), i["message"]))
    return out.withColumns({"issue_texts": texts, "is_valid": passes(F.col("issues"), strict)})


def validate_by_source(samples: DataFrame, config: Mapping[str, Any] | None = None, strict: bool = True) -> DataFrame:
    """As `validate`, with each source's overrides where the configuration has some. Every row is parsed once."""
    named = sorted((config or {}).get("source_overrides", {}))
    others = samples.where(~F.coalesce(F.col("source").isin(named), F.lit(False))) if named else samples
    out = validate(others, config, strict=strict)
    for name in named:
        out = out.unionByName(validate(samples.where(F.col("source") == name), config, name, strict))
    return out


def usable(code_only_sources: list[str] = ()) -> Column:
    """`basic`, or `code_only` for the sources that have no descriptions."""
    loose = F.coalesce(F.col("source").isin(list(code_only_sources)), F.lit(False)) if code_only_sources else F.lit(False)
    return F.when(loose, code_only(F.col("code"))).otherwise(basic(F.col("code"), F.col("description")))


def dry_run(samples: DataFrame) -> DataFrame:
    """Add `would_render`: the code parses, has a scene class by name and the text defines construct."""
    return samples.withColumn("would_render", py_facts(F.col("code"))["dry_run_scene"].isNotNull() & F.coalesce(F.col("code").contains("def construct"), F.lit(False)))


def report(validated: DataFrame) -> DataFrame:
    """Checked, passed, failed and issues by severity in one row."""
    count = lambda s: F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i["severity"] == s))), F.lit(0)).alias(f"n_{s.lower()}")
    return validated.agg(F.count("*").alias("checked"), F.count_if("is_valid").alias("passed"), F.count_if(~F.col("is_valid")).alias("failed"), *map(count, ("CRITICAL", "HIGH", "MEDIUM", "LOW")))


def failures_by_source(validated: DataFrame, examples: int = 10) -> DataFrame:
    """Failed rows by source, with the first examples' first three issues."""
    from sievework.operators.statistics import first_n
    from sievework.operators.store import stored

    failed = validated.where(~F.col("is_valid")).select("source", "seq", F.slice("issue_texts", 1, 3).alias("issues"))
    failed = stored(failed, "quality-failed")  # one parse a row
    each = failed.groupBy("source").agg(F.count("*").alias("failed"))
    shown = first_n(failed, "source", "seq", examples).select("source", F.struct("seq", "issues").alias("x"))
    return each.join(shown.groupBy("source").agg(F.sort_array(F.collect_list("x")).alias("examples")), "source")


def render(samples: DataFrame, render_fn, fix: bool = True) -> DataFrame:
    """Render every sample through `render_fn(code) -> (ok, error)`, an injected callable, retrying repaired code.

    Repaired code that renders replaces the code, with the original kept; a callable that raises counts as a failure.
    """
    import pyarrow as pa

    from sievework.functions.batches import batches_by_slices
    from sievework.functions.fixes import render_fix, render_fix_labels

    names, text = pa.list_(pa.string()), pa.string()
    kinds = {"code": text, "rendering_validated": pa.bool_(), "rendering_failed": pa.bool_(), "auto_fixed": pa.bool_(), "fixes_applied": names, "original_code": text, "render_error": text}

    def attempt(code: str) -> tuple[bool, str]:
        try:
            return render_fn(code)
        except Exception as e:
            return False, f"{type(e).__name__}: {e}"

    def run(batch):
        rows = []
        for code in batch.column("code").to_pylist():
            code = code or ""
            ok, error = attempt(code)
            fixed, fixes = code, []
            if not ok and fix:
                again = render_fix(code, error)
                if again != code:
                    good, later = attempt(again)
                    if good:
                        ok, error, fixed, fixes = True, None, again, render_fix_labels(code, again)
            rows.append((fixed, bool(ok), not ok, bool(fixes) or fixed != code, fixes, code if fixed != code else None, None if ok else error))
        made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())]
        others = [n for n in batch.schema.names if n != "code"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), *made], [*others, *kinds])

    kept = ", ".join(f"`{n}` {t}" for n, t in samples.dtypes if n != "code")
    return samples.mapInArrow(batches_by_slices(run, "code"), f"{kept}, code string, rendering_validated boolean, rendering_failed boolean, auto_fixed boolean, fixes_applied array<string>, original_code string, render_error string")


def looks_like_scene(code: Column) -> Column:
    """The three marks of a scene: the import, a scene class, construct."""
    return code.contains("from manim import") & code.contains("Scene") & code.contains("def construct")


def judge_outputs(outputs: DataFrame, render_fn, answer: str = "answer") -> DataFrame:
    """Model answers as scenes: taken out of their fences, wrapped where there is no scene, validated, and the valid ones rendered.

    Adds code, is_valid, issue_texts, and rendering columns that are null where the code is not valid.
    """
    from sievework.functions.text import ensure_scene, strip_fence

    rows = outputs.withColumn("code", ensure_scene(strip_fence(F.col(answer), "between")))
    if "description" not in rows.columns:
        rows = rows.withColumn("description", F.lit(PENDING))
    judged = validate(rows).drop("issues")
    good = render(judged.where("is_valid"), render_fn)
    return good.unionByName(judged.where(~F.coalesce("is_valid", F.lit(False))), allowMissingColumns=True)
