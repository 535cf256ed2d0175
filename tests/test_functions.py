"""Golden cases of the expressions, code rules and file parsers."""

import json

import pytest
from pyspark.sql import functions as F

from sievework.functions import bundle, fixes, pycode, similarity, text
from sievework.operators import dedup, quality, split, statistics
from sievework.sources import files, tables
from sievework.sources.registry import Registry, Source


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("a", "b", "want"), [("", "a", 0.0), ("a b c", "c a b", 1.0), ("ab", "0123456789", 0.1), ("a b", "a c", 0.8 / 3 + 0.2)])
def test_similarity(spark, a, b, want):
    got = one(spark, similarity.similarity(F.col("a"), F.col("b"), text.token_set(F.col("a")), text.token_set(F.col("b"))), a=a, b=b)
    assert got == pytest.approx(want)


def test_normal_code(spark):
    assert one(spark, text.normalize_code(F.col("c")), c='c = "#FF0000"') == 'c = "'
    assert one(spark, text.normalize_code(F.col("c")), c="# a\n  # b\n\n") == ""
    assert one(spark, text.normalize_code(F.col("c")), c="a\t b  # x\n\n  c") == "a b\nc"


def test_null_and_empty_texts(spark):
    for f in (text.normalize_code, text.normalize_description, text.content_hash, text.ensure_import, text.strip_fence):
        assert one(spark, f(F.col("c")), c=None) is None
        one(spark, f(F.col("c")), c="")


def test_augment(spark):
    assert one(spark, text.augment_prompt(F.col("c"), F.lit(1)), c="Draw a circle") == "Create a Manim animation that draw a circle"


@pytest.mark.parametrize(("words", "want"), [(0, 0.5), (100, 5.0), (5, 2.0)])
def test_spoken(spark, words, want):
    assert one(spark, text.spoken_seconds(F.col("c")), c=" ".join(["w"] * words)) == want
    assert fixes.spoken(" ".join(["w"] * words)) == want


def test_error_order(spark):
    assert one(spark, text.error_bucket(F.col("c")), c="SyntaxError in import") == "import_error"


@pytest.mark.parametrize(
    ("code", "field", "want"),
    [
        ("from manim import Scene as S\nclass A(S):\n    def construct(self): self.wait()", "scene_classes", ["A"]),
        ("class A(Scene): pass\nclass B(A): pass", "scene_classes", ["A", "B"]),
        ("import manim as m\nclass A(m.Scene): pass", "missing_construct", ["A"]),
        ("class A(Scene):\n    def construct(self): ...", "empty_construct", ["A"]),
        ("class A(Scene):\n    def construct(self): pass\nclass B(A): x = 1", "empty_construct", ["A"]),
        ("x = (", "ok", False),
        ("a" * 2_000_000, "ok", True),
        ("(" * 5000 + ")" * 5000, "ok", False),
    ],
)
def test_facts(code, field, want):
    assert pycode.facts(code)[field] == want


@pytest.mark.parametrize(
    ("code", "tag", "has"),
    [
        ("from manimlib.imports import *\n", "manimlib_to_manim_import", "from manim import *"),
        ("from manim import *\nAxes(x_min=-1, x_max=1)", "axes_params_updated", "x_range=[-1, 1]"),
        ("from manim import *\nFadeInFromLarge(a)", "fadeinfromlarge_to_fadein", "FadeIn(a, scale=2)"),
        ("from manim import *\nclass A(Scene):\n    CONFIG = {\n        'a': {1: 2},\n    }\n    x = 1", "removed_config_dict", "x = 1"),
        ("from manim import Create\nDrawBorderThenFill(a)", "added_drawborderthenfill_import", "import Create, DrawBorderThenFill"),
        ("from manim import *\nMathTex('\\alpha')", "tex_escape_sequences_fixed", "MathTex(r'\\alpha')"),
        ("from manim import *\nMathTex(f'\\alpha{x}')", "tex_fstring_escape_fixed", "MathTex(f'\\\\alpha{x}')"),
        ("x = UP + RED", "added_imports_2", "from manim import RED, UP\n"),
        ("from manim import *\nclass A(VoiceoverScene):\n    pass", "voiceoverscene_to_scene", "class A(Scene)"),
    ],
)
def test_fix(code, tag, has):
    fixed, tags = fixes.fix(code)
    assert tag in tags and has in fixed
    assert tag not in fixes.fix("from manim import *\nx = 1")[1]


def test_plain_scene():
    code = 'class A(VoiceoverScene):\n    def construct(self):\n        with self.voiceover(text="one two <bookmark mark=\'a\'/>") as t:\n            self.play(x)\n            self.wait_until_bookmark("a")\n        self.wait()'
    plain, counts = fixes.plain_scene(code)
    assert pycode.parse(plain)[0] is not None and counts == {"blocks": 1, "bookmarks": 1, "classes": 1}
    assert "        self.play(x)\n        self.wait(1)\n        self.wait(0.8)\n        self.wait()" in plain


def test_tree_rewrites():
    assert pycode.rewrite('x = SVGMobject("house.svg")', "assets")[1] == ["building"]
    assert pycode.rewrite("self.play(*xs, run_time=2)", "unpack")[0] == "self.play(AnimationGroup(*xs), run_time=2)"
    assert pycode.rewrite("x = (", "assets") == ("x = (", [])
    assert pycode.required_definitions("f()", "def g(): pass\ndef f(): g()\ndef h(): pass")[1] == ["f", "g"]
    assert pycode.inline_files("x = open('a').read()", {"a": "t"}) == "x = 't'"


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("x = open('a.txt').read().strip()", "x = 'one\\ntwo\\n'.strip()"),
        ("name = 'a.txt'\nx = open(name).readlines()", "name = 'a.txt'\nx = ['one\\n', 'two\\n']"),
        ("with open('a.txt') as f:\n    x = f.read()\n    y = len(x)", "x = 'one\\ntwo\\n'\ny = len(x)"),
        ("f = open('a.txt', 'r')\nx = f.read()", "x = 'one\\ntwo\\n'"),
        ("x = open(Path('d') / 'b').read()", "x = 'b'"),
        ("f = open('a.txt')\nfor line in f: print(line)", None),
        ("x = open('none').read()", None),
        ("x = (", None),
    ],
)
def test_inline_files(code, want):
    done, names = bundle.inline_files(code, {"a.txt": "one\ntwo\n", "d/b": "b"})
    assert done == (want or code) and bool(names) == bool(want)


def test_bundles(spark):
    assert bundle.required_imports("np.sin(pi)\nx = partial(f)", "import functools\nfrom functools import partial\nimport yaml") == ["from manim import *", "import numpy as np", "import math", "from math import *", "import functools", "from functools import partial"]
    tree = "class T:\n    def __init__(self):\n        self.root = None\n\n    def __init__(self, keys):\n        self.insert(keys)\n"
    space = {}
    exec(bundle.merged_methods(tree) + "\n    def insert(self, keys):\n        self.keys = keys\n", space)
    assert space["T"]().root is None and space["T"]([1]).keys == [1]
    made = bundle.bundle_helpers("class S(Scene): pass", [("t.py", "import x\n# c\n\ndef f(): pass"), ("none.py", "import y")])
    assert made.split("\n") == ["from manim import *", "from random import sample", "", "# === t.py utility code ===", "", "def f(): pass", "", "# === Scene class ===", "class S(Scene): pass"]
    cleaned = bundle.clean_code("import sys\nsys.path.insert(0, 'x')\nfrom y import z\nfrom colors import *\nclass A: pass", {"from colors import *": "own colors"})
    assert cleaned == "from manim import *\n\n# Note: own colors\nclass A: pass"
    assert "class Entry" in bundle.stubs("class A(Scene):\n    x = Entry()", {"Entry": "class Entry(VGroup):\n    pass", "Toc": "class Toc: pass"})
    assert one(spark, bundle.described_by_path(F.col("p"), F.lit("A"), {"T": "Topic text"}), p="2022/T/x.py") == "Topic text - A"
    assert one(spark, bundle.described_by_path(F.col("p"), F.lit("A")), p="x.py") == "Animation of A from the General video"
    assert one(spark, bundle.narrated(F.col("c")), c="    # Narration: one\nx\n    # Narration: two") == "one two" and one(spark, bundle.narrated(F.col("c")), c="x") is None
    row = spark.sql("select 'x = open(\\'a\\').read()' as c, map('a', 't') as m").select(bundle.inline_code(F.col("c"), F.col("m")).alias("x")).first()["x"]
    assert (row["code"], row["inlined"]) == ("x = 't'", ["a"])


def test_training_texts_and_model_answers(spark):
    turns = F.array(*(F.struct(F.lit(r).alias("from"), F.lit(v).alias("value")) for r, v in (("system", "s"), ("user", "u"), ("assistant", "c"))))
    text_of = lambda **k: spark.range(1).select(text.training_text(turns, **k).alias("x")).first()["x"]
    assert text_of(fence=True) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n```python\nc\n```<|im_end|>"
    assert text_of(family="llama", eos="</s>").endswith("assistant<|end_header_id|>\n\nc</s>") and text_of(family="x") == "System: s\n\nUser: u\n\nAssistant: c"
    good = "Sure:\n```python\nfrom manim import *\nclass A(Scene):\n    def construct(self):\n        self.play(Create(Circle()))\n```"
    out = spark.createDataFrame([(1, good), (2, "no code"), (3, None)], "id int, answer string")
    got = {r["id"]: (r["is_valid"], r["rendering_validated"]) for r in quality.judge_outputs(out, lambda c: (True, None)).collect()}
    assert got == {1: (True, True), 2: (False, None), 3: (False, None)}
    used = statistics.class_usage(spark.createDataFrame([("class A(Scene):\n    x = Dot(Dot())",)], "code string"))
    assert {(r["kind"], r["name"]): r["n"] for r in used.collect()} == {("inheritance", "Scene"): 1, ("call", "A"): 1, ("call", "Dot"): 2}


def test_reindent():
    code = fixes.reindent("from manim import * class A(Scene): def construct(self): x = Circle() self.play(x)</s>")
    assert pycode.parse(code)[0] is not None


def test_render_fix():
    assert "self.play(" in fixes.render_fix("class A():\n\tdef construct():\n\t\tplay(x)", "NameError")
    assert fixes.render_fix_labels("class A():\n\tplay(x)", "from manim import *\nclass A(Scene):\n    self.play(x)") == ["added_imports", "fixed_indentation", "fixed_scene_inheritance", "added_self_to_methods"]


def brute(rows, priority):
    """The greedy rule over all pairs in order."""

    def sim(a, b):
        if not a or not b:
            return 0.0
        if a == b:
            return 1.0
        r = min(len(a), len(b)) / max(len(a), len(b))
        x, y = set(a.split()), set(b.split())
        return r * 0.5 if r < 0.5 else len(x & y) / len(x | y) * 0.8 + r * 0.2

    gone = set()
    for i, (_, d, c, s) in enumerate(rows):
        if i in gone:
            continue
        for j in range(i + 1, len(rows)):
            if j in gone:
                continue
            code = sim(c, rows[j][2])
            if code == 1.0 or (code > 0.95 and sim(d, rows[j][1]) > 0.95):
                if priority.get(s, 0) >= priority.get(rows[j][3], 0):
                    gone.add(j)
                else:
                    gone.add(i)
                    break
    return {rows[i][0] for i in gone}


def test_greedy_equals_brute_force(spark):
    import random

    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(draw.sample(words, 40)) for _ in range(4)]
    rows = []
    for i in range(90):
        w = draw.choice(base).split()
        for _ in range(draw.choice([0, 0, 1])):
            w[draw.randrange(40)] = draw.choice(words)
        if draw.random() < 0.2:
            draw.shuffle(w)
        rows.append((i, "a description", " ".join(w) if draw.random() > 0.05 else "", draw.choice("abc")))
    priority = {"a": 1, "b": 2}
    s = spark.createDataFrame(rows, "seq long, description string, code string, source string")
    p = spark.createDataFrame(list(priority.items()), "source_id string, priority int")
    removed = dedup.greedy_removed(s, p)
    assert {r["seq"] for r in removed.collect()} == brute(rows, priority)
    assert dedup.removed_examples(removed, s, 5).count() == 5


def test_greedy_of_exact_classes_names_what_each_row_lost_to(spark):
    rows = [(i, "d", c, s) for i, (c, s) in enumerate([("x y", "low"), ("x y", "low"), ("y x", "mid"), ("x y", "low"), ("x y", "high"), ("x y", "mid"), ("", "low"), ("", "low"), (None, "high"), ("q", "low")])]
    s = spark.createDataFrame(rows, "seq long, description string, code string, source string")
    p = spark.createDataFrame([("low", 1), ("mid", 2), ("high", 3)], "source_id string, priority int")
    got = {r["seq"]: (r["kept_seq"], r["desc_sim"]) for r in dedup.greedy_removed(s, p).collect()}
    assert got == {0: (2, None), 1: (0, 1.0), 2: (4, None), 3: (2, None), 5: (4, 1.0)}
    assert dedup.greedy_removed(s.where("false"), p).count() == 0


def test_components_of_a_long_path(spark):
    """However far apart the ends of a chain are, it has one root."""
    n = 150
    chain = spark.range(n - 1).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    roots = dedup.components(chain).collect()
    assert {r["node"] for r in roots} == set(range(1, n)) and {r["root"] for r in roots} == {0}


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_dense_index_keeps_wide_rows(spark, aqe):
    """Under adaptive coalescing, with long columns, and a column called pos."""
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(F.col("doc_id").alias("seq"), "text", F.lit("own").alias("pos"))
        got = split.dense_index(d).select("seq", "idx", F.md5("text").alias("h"), "pos").toPandas().sort_values("seq")
        assert len(got) == 10_000 and got["idx"].tolist() == list(range(10_000)) and set(got["pos"]) == {"own"}
        assert split.modulo_split(d).where("split = 'test'").count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_exact_priority(spark):
    s = spark.createDataFrame([(1, "a", "x y", "low"), (2, "b", "y x", "high"), (3, "c", "", "low"), (4, "d", "", "low")], "seq long, description string, code string, source string")
    p = spark.createDataFrame([("high", 3)], "source_id string, priority int")
    kept = dedup.exact_survivors(dedup.with_priority(dedup.with_keys(s), p))
    assert {r["seq"] for r in kept.collect()} == {2, 3, 4}


def test_config_merge():
    config = {"global_settings": {"a": {"x": 1}, "b": 1}, "source_overrides": {"s": {"a": {"y": 2}, "must_reject": {"k": 1}}}, "validation_actions": {"must_reject": {"m": 2}}}
    assert quality.merged_config(config, "s") == {"a": {"x": 1, "y": 2}, "b": 1, "must_reject": {"m": 2}}


def test_validate_and_render(spark):
    good = "from manim import *\nclass A(Scene):\n    def construct(self):\n        self.play(Create(Circle()))\n"
    rows = [(1, "Draw a circle.", good), (2, "Draw.", "x = ("), (3, None, None)]
    s = spark.createDataFrame(rows, "seq long, description string, code string")
    assert {r["seq"]: r["is_valid"] for r in quality.validate(s).collect()} == {1: True, 2: False, 3: False}

    def fake(code):
        if "Circle" not in code:
            raise RuntimeError("no circle")
        return True, None

    assert {r["seq"]: r["rendering_validated"] for r in quality.render(s, fake).collect()} == {1: True, 2: False, 3: False}


def test_exact_split_sizes(spark):
    for n, ratio in ((1850, 0.1), (10, 0.25), (3, 0.0), (5, 1.0)):
        s = split.exact_split(spark.range(n).withColumnRenamed("id", "seq"), ratio)
        assert s.where("split = 'test'").count() == int(n * ratio) and s.count() == n
    again = split.exact_split(spark.range(1850).repartition(7).withColumnRenamed("id", "seq"), 0.1)
    once = split.exact_split(spark.range(1850).withColumnRenamed("id", "seq"), 0.1)
    assert again.where("split = 'test'").exceptAll(once.where("split = 'test'")).count() == 0


def test_modulo_split(spark):
    s = split.modulo_split(spark.range(12).withColumnRenamed("id", "seq"))
    assert [r["seq"] for r in s.where("split = 'test'").collect()] == [9]


def test_cdf_ties_and_buckets(spark):
    s = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "xx")], "source string, code string")
    assert sorted((r["x"], round(r["low"], 6), round(r["share"], 6)) for r in statistics.length_cdf(s, F.length("code")).collect()) == [(1, 0.333333, 0.666667), (2, 1.0, 1.0)]
    edges = spark.createDataFrame([(n,) for n in (0, 499, 500, 999, 1000, 4999, 5000, 30000)], "n int").select(statistics.bucket(F.col("n")).alias("b"))
    assert [r["b"] for r in edges.collect()] == [0, 0, 1, 1, 2, 6, 7, 7]


def test_class_conflicts(spark):
    code = "class {}(Scene): pass"
    s = spark.createDataFrame([(i, code.format(n)) for i, n in enumerate(["A", "A", "AV2", "A"])], "seq long, code string")
    names = [r["code"] for r in tables.unique_scene_names(s).orderBy("seq").collect()]
    assert names == [code.format(n) for n in ("A", "AV3", "AV2", "AV4")]


def test_sources(spark, tmp_path):
    turn = lambda v: {"from": "x", "value": v}
    good = {"conversations": [turn("s"), turn("Draw"), turn("```python\nclass A(Scene): pass\n```")], "source": "t", "metadata": {"day": "1"}}
    (tmp_path / "c.jsonl").write_text(json.dumps(good) + "\n{bad\n" + json.dumps({"conversations": [turn("s")]}) + "\n")
    assert [r["code"] for r in tables.conversation_lines(spark, f"{tmp_path}/c.jsonl").collect()] == ["class A(Scene): pass"]
    spark.createDataFrame([("Draw it", "x = 1", "nan"), ("nan", "y", "t"), (None, "z", "t")], "`Reviewed Description` string, Code string, Split string").write.parquet(f"{tmp_path}/t")
    assert [r["description"] for r in tables.reviewed_table(spark, f"{tmp_path}/t").collect()] == ["Draw it"]
    long = "```python\n" + "x = 1\n" * 20 + "```"
    spark.createDataFrame([(long,), (long,), ("short",)], "output string").write.parquet(f"{tmp_path}/o")
    assert tables.code_table(spark, f"{tmp_path}/o").count() == 1
    tree = tmp_path / "tree"
    tree.mkdir()
    (tree / "a.py").write_text('from manim import *\nclass BigCircle(Scene):\n    """Draws."""\n    def construct(self): pass\n')
    (tree / "_b.py").write_text("from manim import *\nclass B(Scene): pass\n")
    assert [r["description"] for r in files.scene_tree(spark, str(tree)).collect()] == ["Draws."]
    book = {"cells": [{"cell_type": "code", "source": ["from manim import *"]}, {"cell_type": "markdown", "source": "## A circle"}, {"cell_type": "code", "source": "%%manim\nclass C(Scene): pass"}, {"cell_type": "code", "source": "class BigD(Scene): pass"}]}
    found = files.notebook_samples(json.dumps(book))
    assert [x["description"] for x in found] == ["A circle", "Create an animation of big d"] and found[0]["code"].startswith("from manim import *\n\nclass C")
    assert files.notebook_samples("no json") == []


def test_registry(spark):
    r = Registry()
    r.register(Source("a", lambda spark: spark.createDataFrame([("d", "c")], "description string, code string"), 2))
    r.register(Source("bad", lambda spark: 1 / 0))
    r.register(Source("off", lambda spark: None, default=False))
    with pytest.raises(ValueError, match="registered"):
        r.register(Source("a", lambda spark: None))
    assert r.selected() == ["a", "bad"] and r.selected(["off", "none"]) == ["off"]
    assert r.load(spark, {"a": {}, "bad": {}}).count() == 1


def test_seq_is_stored_and_unique_whatever_the_partitions(spark):
    """Partition ids of 40,000 and more, and sources that number their own rows."""
    r = Registry()
    far = lambda spark: spark.range(3).select((F.lit(40_000 << 33) + F.col("id")).alias("seq"), F.lit("d").alias("description"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("code"))
    r.register(Source("a", far))
    r.register(Source("b", lambda spark: spark.range(50).repartition(40).select(F.lit("d").alias("description"), F.concat(F.lit("x"), (F.col("id") % 3).cast("string")).alias("code"))))
    r.register(Source("shout", lambda spark: spark.createDataFrame([("d", "c")], "description string, code string"), transform=lambda s: s.withColumn("code", F.upper("code"))))
    assert r.load(spark, {"shout": {}}).first()["code"] == "C"
    r.register(Source("late", lambda spark: spark.range(3).select(F.raise_error(F.lit("broken")).alias("description"), F.lit("c").alias("code"))))
    s = r.load(spark, {"a": {}, "b": {}, "late": {}})
    first, again = s.collect(), s.collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert sorted(x["seq"] for x in first) == list(range(53)) and {x["seq"] for x in first if x["source"] == "a"} == {0, 1, 2}
    kept = dedup.greedy_survivors(s, spark.createDataFrame([("b", 2)], "source_id string, priority int")).collect()
    assert len(kept) == 3 and {x["source"] for x in kept} == {"b"}


def test_scene_names_of_a_hot_name(spark):
    code = "class A{}(Scene):\n    pass"
    names = [""] * 6 + ["V3", "V4"] + [""] * 3
    s = spark.createDataFrame([(i, code.format(n)) for i, n in enumerate(names)], "seq long, code string").repartition(4)
    got = [x["code"].split("(")[0][6:] for x in tables.unique_scene_names(s).orderBy("seq").collect()]
    assert got == ["A", "AV2", "AV5", "AV6", "AV7", "AV8", "AV3", "AV4", "AV9", "AV10", "AV11"]


def test_reports_and_command_line(spark, tmp_path, capsys):
    from sievework import cli

    good = "from manim import *\nclass A{0}(Scene):\n    def construct(self):\n        self.play(ShowCreation(Circle(radius={0})))\n"
    rows = [(f"Draw circle number {i}.", good.format(i % 9)) for i in range(12)] + [("A sentence.", "not python at all, but long")]
    spark.createDataFrame(rows, "`Reviewed Description` string, Code string").write.parquet(f"{tmp_path}/t")
    (tmp_path / "settings.json").write_text(json.dumps({"reviewed_table": {"path": f"{tmp_path}/t"}}))
    (tmp_path / "rules.json").write_text(json.dumps({"global_settings": {"enable_quality_validation": True}, "source_overrides": {"reviewed_table": {"must_reject": {"code_below_minimum": {"enabled": True, "min_length": 5}}}}}))
    out = f"{tmp_path}/out"
    args = ["--settings", f"{tmp_path}/settings.json", "--quality-config", f"{tmp_path}/rules.json", "--output-dir", out, "--fix-code", "--augmentation", "--enable-rendering", "--renderer", "tests.test_functions:renderer", "--fill-descriptions", "--describer", "tests.test_functions:describer"]
    cli.main(args)
    one = lambda name: spark.read.json(f"{out}/{name}").first()
    report = one("deduplication_report")
    assert (report["total_raw_samples"], report["duplicates_removed"], report["unique_samples"]) == (12, 3, 9) and report["kept_by_source"]["reviewed_table"] == 9
    assert spark.read.json(f"{out}/removed_duplicates").count() == 3
    assert one("code_fixing")["samples_fixed"] == 9 and one("code_fixing")["fixes_by_type"]["showcreation_to_create"] == 9
    rendered = one("rendering_validation_report")
    assert (rendered["valid_samples"], rendered["invalid_samples"]) == (8, 1) and rendered["failures_by_source"]["reviewed_table"] == 1
    stats = one("dataset_stats")
    assert stats["train_before_augmentation"] == 8 and stats["test"] == 0 and stats["augmentation_factor"] >= 2
    assert spark.read.json(f"{out}/train").count() == stats["train_after_augmentation"]
    cli.main(["--list-sources"])
    assert "reviewed_table: Reviewed table (priority=4)" in capsys.readouterr().out
    assert not cli.config(cli.parser().parse_args(["--no-quality-validation"])).validate and cli.config(cli.parser().parse_args([])).strict


def renderer(code, timeout, **_):
    return "radius=3" not in code and timeout == 30, "TypeError"


def describer(codes):
    return ["Described." for _ in codes]


def test_overrides_by_source(spark):
    short = "from manim import *\nclass A(Scene):\n    def construct(self):\n        self.play(Create(Dot()))\n"
    s = spark.createDataFrame([(1, "Draw a dot.", short, "a"), (2, "Draw a dot.", short, "b"), (3, "Draw a dot.", short, None)], "seq long, description string, code string, source string")
    config = {"source_overrides": {"a": {"must_reject": {"code_below_minimum": {"enabled": True, "min_length": 500}}}}}
    assert {r["seq"]: r["is_valid"] for r in quality.validate_by_source(s, config).collect()} == {1: False, 2: True, 3: True}
    bare = spark.createDataFrame([(1, None, "x = 1; y = 2; z = 3; print(x)", "a"), (2, None, "x = 1; y = 2; z = 3; print(x)", "b")], "seq long, description string, code string, source string")
    assert [r["seq"] for r in bare.where(quality.usable(["a"])).collect()] == [1]


def test_examples_round_trip_and_path_metadata(spark, tmp_path):
    from sievework.sources import sinks

    s = spark.createDataFrame([("Basic: A", "class A(Scene):\n    pass", "Basic", "A", "u")], "description string, code string, category string, example_name string, original_url string")
    sinks.write_examples(s, f"{tmp_path}/cache")
    assert [tuple(r) for r in sinks.read_examples(spark, f"{tmp_path}/cache").collect()] == [tuple(r) for r in s.collect()]
    told = json.loads(one(spark, files.day_metadata(F.col("p")), p="/x/Day_07/Version2/scene.py"))
    assert told == {"aoc_day": 7, "original_context": "Advent of Code 2024 Day 7", "version": 2} and one(spark, files.day_metadata(F.col("p")), p="/x") == "{}"
    scene = "import os\nfrom manim import *\n\nclass A(Scene):\n    x = 1\n\n    def f(self):\n        pass\ny = 2\n"
    assert files.regex_scenes(scene) == [{"name": "A", "code": "from manim import *\n\nclass A(Scene):\n    x = 1\n\n    def f(self):\n        pass"}]
    named = spark.createDataFrame([("/a/e.py",), ("/a/f.py",)], "source_file string")
    titled = files.titled_metadata(named, spark.createDataFrame([("e.py", "u", "t")], "file string, url string, title string"))
    assert {r["source_file"]: (r["video_title"], r["has_transcript"]) for r in titled.collect()} == {"/a/e.py": ("t", True), "/a/f.py": (None, None)}
    (tmp_path / "03_graphs_and_trees.ipynb").write_text("{}")
    assert tuple(spark.range(1).select(files.episode(F.lit("/x/03_graphs-and_trees.ipynb")).alias("e")).first()["e"]) == (3, "graphs and trees")


def test_curate(spark, tmp_path):
    from sievework.plans.curate import Config, curate

    code = "from manim import *\nclass A{0}(Scene):\n    def construct(self):\n        self.play(ShowCreation(Circle(radius={0})))\n"
    spark.createDataFrame([(f"Draw circle number {i}.", code.format(i % 15)) for i in range(20)], "`Reviewed Description` string, Code string").write.parquet(f"{tmp_path}/t")
    config = Config(output=f"{tmp_path}/out", sources={"reviewed_table": {"path": f"{tmp_path}/t"}}, fix_code=True, augment=True, test_ratio=0.2)
    done = curate(spark, config)
    assert done["after_deduplication"].count() == 15 and done["final_test"].count() == 3
    assert spark.read.json(f"{tmp_path}/out/tracking").where("source is null").first()["after_rendering"] == 15
    assert spark.read.json(f"{tmp_path}/out/test").count() == 3
    assert all(r["auto_fixed"] for r in done["after_code_fixing"].collect())


def test_stream(spark, tmp_path):
    from sievework.streaming.ingest import ingest

    turn = lambda v: {"from": "x", "value": v}
    (tmp_path / "in").mkdir()
    for k in range(2):
        rows = [{"conversations": [turn("s"), turn("Draw it"), turn("x = 'a long enough text'" + str(i))], "source": "t"} for i in range(3)]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(map(json.dumps, rows)))
        ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_code_of_over_a_million_characters_is_parsed():
    code = "from manim import *\n\n\nclass Long(Scene):\n    def construct(self):\n        self.wait()\n" + "x = 1  # padding padding padding\n" * 40_000
    assert len(code) > 1_000_000 and pycode.facts(code)["scene_classes"] == ["Long"] and pycode.facts(code)["ok"]
    assert [s["name"] for s in pycode.scene_sources(code)] == ["Long"]
    assert pycode.facts("(" * 100_000)["ok"] is False


def stored_tables(monkeypatch):
    """What the de-duplication stores from now on: (tag, columns, rows)."""
    seen, plain = [], dedup.stored

    def noted(df, tag):
        out = plain(df, tag)
        seen.append((tag, out.columns, out.count()))
        return out

    monkeypatch.setattr(dedup, "stored", noted)
    return seen


def test_texts_that_share_a_rare_word_alone_are_no_candidates(spark, monkeypatch):
    import random

    draw, pool = random.Random(4), [f"w{i}" for i in range(150)]
    texts = [" ".join(draw.sample(pool, 90) + ["rare"] * (i % 2)) for i in range(80)]
    texts.append(texts[1].replace("rare", "rarer"))  # 90 of 92 words: 0.98
    seen = stored_tables(monkeypatch)
    rows = spark.createDataFrame([(i, x, x, "a") for i, x in enumerate(texts)], "seq long, description string, code string, source string")
    assert [(r["i"], r["j"]) for r in dedup.prefix_edges(dedup.with_keys(rows), code_only=True).collect()] == [(1, 80)]
    assert [n for tag, _, n in seen if tag == "dedup-pairs"] == [1]


def test_near_pairs_of_all_sizes_are_found(spark):
    import random

    draw, texts = random.Random(5), []
    for n in [*range(1, 60, 3), 100, 137, 250, 400, 1500]:
        words = [f"{n}w{i}" for i in range(n)]
        texts.append(words)
        for share in (0.01, 0.03, 0.05, 0.06):
            k = round(n * share)
            texts.append([w for w in words if w not in draw.sample(words, k // 2)] + [f"{n}x{i}" for i in range(k - k // 2)])
            texts.append(words[: n - k])
            texts.append(words + [f"{n}y{i}" for i in range(k)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, x, x, "a") for i, x in rows], "seq long, description string, code string, source string")
    first = {}
    for i, x in rows:
        first.setdefault(x, i)
    keep, want = sorted(first.values()), set()
    for a, i in enumerate(keep):
        for j in keep[a + 1 :]:
            x, y = set(texts[i]), set(texts[j])
            r = min(len(rows[i][1]), len(rows[j][1])) / max(len(rows[i][1]), len(rows[j][1]))
            if r >= 0.5 and len(x & y) / len(x | y) * 0.8 + r * 0.2 > 0.95:
                want.add((i, j))
    assert {(r["i"], r["j"]) for r in dedup.prefix_edges(dedup.with_keys(df), code_only=True).collect()} == want and len(want) > 100


def test_greedy_stores_no_texts_but_of_near_pairs(spark, monkeypatch):
    seen = stored_tables(monkeypatch)
    texts = ["a b c d", "a b c d", "e f g h", "i j k l m"]
    rows = spark.createDataFrame([(i, x, x, "s") for i, x in enumerate(texts)], "seq long, description string, code string, source string")
    removed = dedup.greedy_removed(rows, spark.createDataFrame([("s", 1)], "source_id string, priority int"))
    assert [(r["seq"], r["kept_seq"]) for r in removed.collect()] == [(1, 0)]
    wide = {"n_code", "n_desc", "t_code", "t_desc"}
    assert [(tag, n) for tag, columns, n in seen if wide & set(columns) and n] == []


def test_curriculum_cuts_are_exact(spark):
    rows = spark.range(300_001).select(((F.col("id") * 7919) % 300_001).alias("x")).unionByName(spark.createDataFrame([(None,)], "x long"))
    got = {r["level"]: (r["a"], r["b"]) for r in split.curriculum(rows, F.col("x")).groupBy("level").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()}
    assert got == {0: (0, 75_000), 1: (75_001, 150_000), 2: (150_001, 225_000), 3: (225_001, 300_000), None: (None, None)}


def test_no_repair_pattern_runs_without_its_words(spark):
    """Patterns that start with a repeat need the square of a word's length where nothing matches."""
    assert [r.tag for r in fixes.NATIVE if not r.needs] == []
    code = "x" * 400_000
    assert spark.createDataFrame([(code,)], "code string").select(fixes.native_fixes(F.col("code")).alias("f")).first()["f"] == (code, [])


def test_python_work_takes_a_slice_of_a_batch_at_a_time(spark):
    import pyarrow as pa

    from sievework.functions.batches import SLICE, by_slices, slices

    texts = ["a" * 300_000, None, "b" * 3 * SLICE, "", *["c" * 400_000] * 9]
    seen = []

    def shout(values):
        seen.append(values)
        return [None if v is None else v.upper() for v in values]

    assert by_slices(shout, pa.string(), pa.array(texts)).to_pylist() == shout(texts)
    assert [v for values in seen[:-1] for v in values] == texts
    assert max(sum(len(v or "") for v in values) for values in seen[:-1] if len(values) > 1) <= 2 * SLICE
    assert list(slices(pa.array([], pa.string()))) == [] and by_slices(shout, pa.string(), pa.array([], pa.string())).to_pylist() == []
    rows = spark.createDataFrame([(i, f"self.play(ShowCreation(c))\n# {x}") for i, x in enumerate(texts)], "seq long, code string").repartition(1)
    done = quality.render(rows, lambda code: ("Create(" in code and "Show" not in code, "NameError: ShowCreation")).collect()
    assert sorted(r["seq"] for r in done) == list(range(len(texts)))
    assert all(r["rendering_validated"] and r["fixes_applied"] and r["original_code"] == f"self.play(ShowCreation(c))\n# {texts[r['seq']]}" for r in done)
