"""Every operator as a query over the test tables, with SQL of the same meaning where SQL has one.

`documents` stands for samples: seq is doc_id, the whole text is description and code. Where a rule looks at Python
the code is a scene that `CODE` puts above the whole text, as a comment, in a form that both engines share; the SQL
reads that code and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import fixes, pycode, similarity, text
from sievework.operators import dedup, descriptions, quality, split, statistics
from sievework.sources import files, tables
from sievework.sources.registry import REGISTRY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The whole text as comment lines.
_COMMENT = "concat('# ', replace(text, chr(10), concat(chr(10), '# ')), chr(10))"
_SCENE = f"concat('from manim import *', chr(10), chr(10), 'class S', doc_id, '(Scene):', chr(10), '    def construct(self):', chr(10)"
#: Python above a document, by doc_id: sound scenes, and one fault or outdated call each; and a document as it is.
CODE = f"""CASE doc_id % 16
 WHEN 0 THEN {_SCENE}, '        c = Circle()', chr(10), '        self.play(ShowCreation(c))', chr(10), '        self.wait(', doc_id % 7, ')', chr(10), {_COMMENT})
 WHEN 1 THEN {_SCENE}, '        t = TextMobject("a")', chr(10), '        t.set_width(', doc_id % 5, ')', chr(10), '        self.play(FadeInFromDown(t))', chr(10), {_COMMENT})
 WHEN 2 THEN {_SCENE}, '        s = Square()', chr(10), '        self.add(s)', chr(10), '        self.play(s.animate.shift(UP))', chr(10), {_COMMENT})
 WHEN 3 THEN concat('class S', doc_id, '(Scene):', chr(10), '    def construct(self):', chr(10), '        self.play(Write(MathTex("x")))', chr(10), {_COMMENT})
 WHEN 4 THEN {_SCENE}, '        pass', chr(10), {_COMMENT})
 WHEN 5 THEN concat('from manim import *', chr(10), 'x = Circle()', chr(10), 'print("', doc_id, '", x)', chr(10), {_COMMENT})
 WHEN 6 THEN {_SCENE}, '        # Your code here', chr(10), '        self.play(FadeOutAndShift(d, UP))', chr(10), {_COMMENT})
 WHEN 7 THEN concat('from manim import *', chr(10), 'class S', doc_id, '(Scene:', chr(10), '    def construct(self)', chr(10), {_COMMENT})
 WHEN 8 THEN {_SCENE}, '        a = Axes()', chr(10), '        self.play(Write(a))', chr(10), '        h = a.get_height()', chr(10), {_COMMENT})
 WHEN 9 THEN concat('x = ', doc_id, chr(10), {_COMMENT})
 WHEN 10 THEN {_SCENE}, '        d = Dot()', chr(10), '        print(d.center[0])', chr(10), '        self.remove(d)', chr(10), {_COMMENT})
 WHEN 11 THEN {_SCENE}, '        ...', chr(10), '        self.wait()', chr(10), {_COMMENT})
 WHEN 12 THEN {_SCENE}, '        self.play(FadeInFrom(Arrow(), LEFT))', chr(10), {_COMMENT})
 WHEN 13 THEN concat('from manim import *', chr(10), 'class S', doc_id, '(Scene):', chr(10), '    x = Line()', chr(10), '    y = "self.play("', chr(10), {_COMMENT})
 WHEN 14 THEN {_SCENE}, '        t = TexMobject("y", tex_to_color_map=m)', chr(10), '        self.play(Write(t))', chr(10), {_COMMENT})
 ELSE text END"""
#: As CODE, with a document's text below an assignment where it would be plain prose, which SQL cannot parse.
PYTHON = CODE.replace("ELSE text END", f"ELSE concat('z', doc_id, ' = 1', chr(10), {_COMMENT}) END")

_PRIORITY = "CAST(substr(source, 4) AS INT) % 5 + 1"
_ND = r"trim(regexp_replace(lower(%s), '\s+', ' ', 'g'))"
_NC = r"array_to_string(list_filter(list_transform(string_split(%s, chr(10)), lambda l: trim(regexp_replace(split_part(l, '#', 1), '\s+', ' ', 'g'))), lambda l: l <> ''), chr(10))"
_TOKENS = r"list_sort(list_distinct(list_filter(regexp_split_to_array(%s, '\s+'), lambda t: t <> '')))"
_KEY = f"concat(length(n_code), ' ', array_to_string({_TOKENS % 'n_code'}, ' '))"
_SAMPLES = "SELECT doc_id AS seq, source, text AS code, text AS description FROM documents"
_KEPT = f"""k AS (SELECT seq, source, n_code, {_KEY} AS key, {_PRIORITY} AS priority FROM (SELECT seq, source, {_NC % 'code'} AS n_code FROM ({_SAMPLES}))),
kept AS (SELECT seq, source FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY priority DESC, seq) AS r FROM k WHERE n_code <> '') WHERE r = 1 UNION ALL SELECT seq, source FROM k WHERE n_code = '')"""


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.col("text").alias("description"), F.col("text").alias("code"), "source")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples whose code is Python."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.col("text").alias("description"), F.expr(CODE).alias("code"), "source")


def python_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples whose code is Python without exception, but for the faulty scenes."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.expr(PYTHON).alias("code"))


def priorities(df: DataFrame) -> DataFrame:
    return df.select(F.col("source").alias("source_id")).distinct().withColumn("priority", F.expr("CAST(substr(source_id, 4) AS INT) % 5 + 1"))


# Text


@query(f"SELECT seq, {_ND % 'description'} AS n FROM ({_SAMPLES})")
def normalize_description(spark, sf_dir):
    return samples(spark, sf_dir).select("seq", text.normalize_description(F.col("description")).alias("n"))


@query(f"SELECT seq, {_NC % 'code'} AS n FROM ({_SAMPLES})")
def normalize_code(spark, sf_dir):
    return samples(spark, sf_dir).select("seq", text.normalize_code(F.col("code")).alias("n"))


@query("SELECT doc_id AS seq, substr(sha256(text), 1, 16) AS h FROM documents")
def content_hash(spark, sf_dir):
    return samples(spark, sf_dir).select("seq", text.content_hash(F.col("code")).alias("h"))


_FENCED = "CASE doc_id % 3 WHEN 0 THEN concat('```python', chr(10), text, chr(10), '```') WHEN 1 THEN concat('```python', chr(10), text) ELSE text END"


@query(
    f"""SELECT doc_id AS seq,
 trim(CASE WHEN suffix(p, '```') THEN p[1:length(p) - 3] ELSE p END, concat(' ', chr(9), chr(10), chr(13))) AS a_prefix,
 CASE WHEN contains(x, '```python') THEN trim(string_split(string_split(x, '```python')[2], '```')[1], concat(' ', chr(9), chr(10), chr(13))) ELSE x END AS b_between,
 CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN text ELSE text END AS c_regex,
 substr(x, 10, greatest(length(x) - 12, 0)) AS d_slice
FROM (SELECT *, CASE WHEN starts_with(x, '```python') THEN substr(x, 10) ELSE x END AS p FROM (SELECT doc_id, text, {_FENCED} AS x FROM documents))"""
)
def strip_fences(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("x", F.expr(_FENCED))
    return d.select(F.col("doc_id").alias("seq"), *(text.strip_fence(F.col("x"), s).alias(f"{n}_{s}") for n, s in zip("abcd", text.FENCES, strict=True)))


@query(f"SELECT doc_id AS seq, CASE WHEN contains(x, 'import') THEN x ELSE concat('from manim import *', chr(10), chr(10), x) END AS code FROM (SELECT doc_id, trim({CODE}, concat(' ', chr(9), chr(10), chr(13))) AS x FROM documents)")
def ensure_import(spark, sf_dir):
    return scenes(spark, sf_dir).select("seq", text.ensure_import(F.col("code")).alias("code"))


_ENSURED = """CASE
 WHEN contains(x, 'class') AND contains(x, 'Scene') AND contains(x, 'def construct') THEN x
 WHEN NOT starts_with(x, 'from manim import') THEN concat('from manim import *', chr(10), chr(10), 'class AnimationScene(Scene):', chr(10), '    def construct(self):', chr(10), array_to_string(list_transform(string_split(x, chr(10)), lambda l: CASE WHEN trim(l) <> '' THEN '        ' || l ELSE '' END), chr(10)), chr(10))
 WHEN NOT (contains(x, 'class') AND contains(x, 'Scene')) THEN concat(x, chr(10), chr(10), 'class AnimationScene(Scene):', chr(10), '    def construct(self):', chr(10), '        ')
 ELSE x END"""
_STRIPPED = f"(SELECT doc_id, trim({CODE}, concat(' ', chr(9), chr(10), chr(13))) AS x FROM documents)"


@query(f"SELECT doc_id AS seq, {_ENSURED} AS code FROM {_STRIPPED}")
def ensure_scene(spark, sf_dir):
    return scenes(spark, sf_dir).select("seq", text.ensure_scene(F.col("code")).alias("code"))


_PROMPT = "CASE k % 6 WHEN 0 THEN d WHEN 1 THEN 'Create a Manim animation that ' || l WHEN 2 THEN 'Write Manim code to ' || l WHEN 3 THEN 'Generate a Manim scene that ' || l WHEN 4 THEN 'Implement a Manim animation for: ' || d ELSE 'Using Manim, ' || l END"
_LOWERED = "CASE WHEN upper(left(text, 1)) = left(text, 1) THEN lower(left(text, 1)) || substr(text, 2) ELSE text END"


@query(
    f"""SELECT seq, CASE seq % 6 WHEN 0 THEN d WHEN 1 THEN 'Create a Manim animation that ' || l WHEN 2 THEN 'Write Manim code to ' || l WHEN 3 THEN 'Generate a Manim scene that ' || l WHEN 4 THEN 'Implement a Manim animation for: ' || d ELSE 'Using Manim, ' || l END AS prompt
FROM (SELECT seq, description AS d, CASE WHEN upper(left(description, 1)) = left(description, 1) THEN lower(left(description, 1)) || substr(description, 2) ELSE description END AS l FROM ({_SAMPLES}))"""
)
def augment_templates(spark, sf_dir):
    return samples(spark, sf_dir).select("seq", text.augment_prompt(F.col("description"), F.col("seq")).alias("prompt"))


_DESCRIBED = "CASE doc_id % 5 WHEN 0 THEN concat('[PENDING_DESCRIPTION] ', source) WHEN 1 THEN text WHEN 2 THEN concat('todo: describe it well ', source) ELSE text END"


@query(f"SELECT doc_id AS seq, starts_with(d, '[PENDING_DESCRIPTION]') OR length(d) < 20 OR (contains(d, '[') AND contains(d, ']')) OR contains(upper(d), 'TODO') OR contains(upper(d), 'PLACEHOLDER') OR trim(d) = '' AS needs FROM (SELECT doc_id, {_DESCRIBED} AS d FROM documents)")
def placeholder_flags(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), text.needs_description(F.expr(_DESCRIBED)).alias("needs"))


_FEATURES = f"""SELECT seq, contains(c, 'ThreeDScene') OR contains(c, 'ThreeDAxes') OR contains(c, 'Surface') AS has_3d, contains(c, 'MathTex') OR contains(c, 'Tex(') AS has_latex,
 contains(c, 'Axes') OR contains(c, 'NumberPlane') OR contains(c, 'Graph') AS has_graphs, contains(c, '.animate') AS has_animations,
 list_filter([CASE WHEN contains(c, 'Circle(') THEN 'circles' END, CASE WHEN contains(c, 'Square(') THEN 'squares' END, CASE WHEN contains(c, 'Rectangle(') THEN 'rectangles' END, CASE WHEN contains(c, 'Line(') THEN 'lines' END, CASE WHEN contains(c, 'Arrow(') THEN 'arrows' END, CASE WHEN contains(c, 'Text(') THEN 'text' END, CASE WHEN contains(c, 'MathTex(') THEN 'equations' END, CASE WHEN contains(c, 'VGroup(') THEN 'groups' END, CASE WHEN regexp_matches(c, '(Surface|Sphere|Cube|Cylinder)\\(') THEN '3d_objects' END, CASE WHEN contains(c, 'Triangle(') THEN 'triangles' END, CASE WHEN contains(c, 'Polygon(') THEN 'polygons' END, CASE WHEN contains(c, 'Dot(') THEN 'dots' END], lambda e: e IS NOT NULL) AS e
FROM (SELECT doc_id AS seq, {CODE} AS c FROM documents)"""


@query(f"SELECT seq, has_3d, has_latex, has_graphs, has_animations, array_to_string(e, ',') AS elements FROM ({_FEATURES})")
def code_features(spark, sf_dir):
    f = scenes(spark, sf_dir).select("seq", text.code_features(F.col("code")).alias("f"))
    return f.select("seq", "f.has_3d", "f.has_latex", "f.has_graphs", "f.has_animations", F.array_join("f.visual_elements", ",").alias("elements"))


@query(f"SELECT seq, CASE WHEN len(e) > 0 THEN 'Create an animation that shows ' || array_to_string(e[1:3], ', ') || CASE WHEN has_3d THEN ' in 3D space' ELSE '' END || CASE WHEN has_latex THEN ' with mathematical equations' ELSE '' END ELSE 'Create a Manim animation for this concept' END AS description FROM ({_FEATURES})")
def fallback_description(spark, sf_dir):
    return scenes(spark, sf_dir).select("seq", text.fallback_description(text.code_features(F.col("code"))).alias("description"))


@query(f"SELECT seq, round(greatest(0.5, least(5.0, n * 60 / 150)), 1) AS seconds FROM (SELECT seq, CAST(len(list_filter(regexp_split_to_array(description, '\\s+'), lambda w: w <> '')) AS DOUBLE) AS n FROM ({_SAMPLES}))")
def duration_estimate(spark, sf_dir):
    return samples(spark, sf_dir).select("seq", text.spoken_seconds(F.col("description")).alias("seconds"))


_ERROR = "concat(CASE doc_id % 9 WHEN 0 THEN 'ImportError: x ' WHEN 1 THEN 'SyntaxError ' WHEN 2 THEN 'Timeout ' WHEN 3 THEN 'No video file ' WHEN 4 THEN 'AttributeError: ' WHEN 5 THEN 'TypeError ' WHEN 6 THEN 'NameError ' WHEN 7 THEN 'syntax of import ' ELSE '' END, text)"


@query(
    f"""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN contains(m, 'no module named') OR contains(m, 'import') THEN 'import_error' WHEN contains(m, 'syntax') THEN 'syntax_error' WHEN contains(m, 'timeout') THEN 'timeout' WHEN contains(m, 'no video file') OR contains(m, 'no png file') THEN 'no_output' WHEN contains(m, 'attributeerror') THEN 'attribute_error' WHEN contains(m, 'typeerror') THEN 'type_error' WHEN contains(m, 'nameerror') THEN 'name_error' ELSE 'other' END AS bucket
FROM (SELECT lower({_ERROR}) AS m FROM documents)) GROUP BY bucket"""
)
def error_taxonomy(spark, sf_dir):
    return documents(spark, sf_dir).groupBy(text.error_bucket(F.expr(_ERROR)).alias("bucket")).agg(F.count("*").alias("n"))


_CHAT = "'<|im_start|>' || t.\"from\" || chr(10) || CASE WHEN t.\"from\" = 'assistant' AND NOT contains(t.value, '```') THEN '```python' || chr(10) || t.value || chr(10) || '```' ELSE t.value END || '<|im_end|>' || chr(10)"


@query("SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || CASE WHEN role = 'assistant' AND NOT contains(text, '```') THEN '```python' || chr(10) || text || chr(10) || '```' ELSE text END || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text FROM conversations GROUP BY conv_id")
def chat_text(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return split.from_turns(turns).select("conv_id", text.chat_text(F.col("conversations")).alias("text"))


# De-duplication and similarity


@query(f"WITH {_KEPT} SELECT seq FROM kept")
def exact_dedup_survivors(spark, sf_dir):
    s = samples(spark, sf_dir)
    return dedup.exact_survivors(dedup.with_priority(dedup.with_keys(s), priorities(s))).select("seq")


@query(f"WITH {_KEPT} SELECT d.source, count(*) AS total, count(kept.seq) AS kept FROM documents d LEFT JOIN kept ON kept.seq = d.doc_id GROUP BY d.source")
def exact_dedup_by_source(spark, sf_dir):
    s = samples(spark, sf_dir)
    left = exact_dedup_survivors(spark, sf_dir).withColumn("kept", F.lit(1))
    return s.select("seq", "source").join(left, "seq", "left").groupBy("source").agg(F.count("*").alias("total"), F.count("kept").alias("kept"))


@query("SELECT min(doc_id) AS seq FROM documents GROUP BY source, text")
def within_source_distinct(spark, sf_dir):
    return dedup.distinct_by(samples(spark, sf_dir), "source", "code").select("seq")


@query("SELECT doc_id AS seq FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT source) = 1)")
def conflicting_descriptions_drop(spark, sf_dir):
    return dedup.conflicting_descriptions_dropped(samples(spark, sf_dir).withColumn("description", F.col("source"))).select("seq")


@query(f"SELECT doc_id AS seq, {_PRIORITY} AS priority FROM documents WHERE source <> 'src3' UNION ALL SELECT doc_id, 0 FROM documents WHERE source = 'src3'")
def priority_lookup(spark, sf_dir):
    s = samples(spark, sf_dir)
    return dedup.with_priority(s, priorities(s).where("source_id <> 'src3'")).select("seq", "priority")


_SIM = """CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0.0 WHEN a = b THEN 1.0
 WHEN least(length(a), length(b)) / CAST(greatest(length(a), length(b)) AS DOUBLE) < 0.5 OR len(ta) = 0 OR len(tb) = 0 THEN least(length(a), length(b)) / CAST(greatest(length(a), length(b)) AS DOUBLE) * 0.5
 ELSE len(list_intersect(ta, tb)) / CAST(len(ta) + len(tb) - len(list_intersect(ta, tb)) AS DOUBLE) * 0.8 + least(length(a), length(b)) / CAST(greatest(length(a), length(b)) AS DOUBLE) * 0.2 END"""
_NEXT = f"WITH n AS (SELECT seq, {_NC % 'code'} AS c FROM ({_SAMPLES})), p AS (SELECT x.seq, x.c AS a, y.c AS b, {_TOKENS % 'x.c'} AS ta, {_TOKENS % 'y.c'} AS tb FROM n x JOIN n y ON y.seq = x.seq + 1)"


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = dedup.with_keys(samples(spark, sf_dir)).select("seq", "n_code", "t_code")
    after = n.select((F.col("seq") - 1).alias("seq"), F.col("n_code").alias("b"), F.col("t_code").alias("tb"))
    return n.join(after, "seq").select("seq", similarity.similarity(F.col("n_code"), F.col("b"), F.col("t_code"), F.col("tb")).alias("code_sim"))


@query(f"{_NEXT} SELECT seq, round({_SIM}, 9) AS code_sim FROM p")
def neighbour_similarity(spark, sf_dir):
    return _neighbours(spark, sf_dir).select("seq", F.round("code_sim", 9).alias("code_sim"))


@query(f"{_NEXT} SELECT round({_SIM}, 1) AS bucket, count(*) AS pairs FROM p GROUP BY bucket")
def similarity_histogram(spark, sf_dir):
    return dedup.similarity_histogram(_neighbours(spark, sf_dir))


@query(
    f"""WITH n AS (SELECT min(seq) AS seq, c, d FROM (SELECT seq, {_NC % 'code'} AS c, {_ND % 'description'} AS d FROM ({_SAMPLES})) WHERE c <> '' GROUP BY c, d),
t AS (SELECT seq, c, length(c) AS len, {_TOKENS % 'c'} AS tok FROM n),
p AS (SELECT x.seq AS i, y.seq AS j, x.c AS a, y.c AS b, x.tok AS ta, y.tok AS tb FROM t x JOIN t y ON x.seq < y.seq AND least(x.len, y.len) >= 0.75 * greatest(x.len, y.len) AND least(len(x.tok), len(y.tok)) >= 0.93 * greatest(len(x.tok), len(y.tok)))
SELECT i, j, round(s, 6) AS code_sim FROM (SELECT i, j, {_SIM} AS s FROM p) WHERE s > 0.95"""
)
def near_dup_edges(spark, sf_dir):
    return dedup.prefix_edges(dedup.with_keys(samples(spark, sf_dir)), code_only=True).select("i", "j", F.round("code_sim", 6).alias("code_sim"))


@query()
def greedy_dedup(spark, sf_dir):
    s = samples(spark, sf_dir)
    return dedup.greedy_removed(s, priorities(s))


@query("SELECT count(*) AS total, count(DISTINCT text) AS unique_codes, count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, source FROM documents)) AS exact_pair_duplicates, (SELECT count(*) FROM (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT source) > 1)) AS conflicting_codes FROM documents")
def duplicate_analysis(spark, sf_dir):
    return statistics.duplicate_analysis(samples(spark, sf_dir).withColumn("description", F.col("source")))


# Quality


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE length(text) >= 20 AND length(text) >= 5) AS valid FROM documents GROUP BY source")
def basic_validation(spark, sf_dir):
    return samples(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.count_if(quality.basic(F.col("code"), F.col("description"))).alias("valid"))


_OBJECTS = "|".join(quality.OBJECTS)
_METHODS = "|".join(quality.METHODS)
_SHAPE = " ".join(f"WHEN contains(lower(d), '{n}') AND NOT ({' OR '.join(f'''contains(c, '{w}')''' for w in signs)}) THEN '{n}'" for n, signs in quality.SHAPES.items())
_DESC = "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'Create a Manim animation.' WHEN 2 THEN concat('a circle and a ', text) WHEN 3 THEN concat('Draw [TODO] ', text) WHEN 4 THEN '[PLACEHOLDER] later' ELSE text END"
_RULES = rf"""r AS (SELECT *, NOT (d = '' OR starts_with(d, '[PENDING_DESCRIPTION]') OR starts_with(d, '[PLACEHOLDER')) AS asks FROM (SELECT doc_id AS seq, {_DESC} AS d, {CODE} AS c FROM documents)),
i AS (SELECT seq, list_filter([
 CASE WHEN trim(d) = '' THEN 'V2' END,
 CASE WHEN asks AND trim(d) <> '' AND regexp_matches(d, '(?i)\[(TODO|FIXME|INSERT|TBD|PLACEHOLDER)') THEN 'V4' END,
 CASE WHEN asks AND trim(d) <> '' AND length(d) < 50 AND regexp_matches(d, '^(Create a Manim animation|Create an animation|Manim scene)') THEN 'V5' END,
 CASE WHEN regexp_matches(c, '(?i)#\s*(Your code here|Implementation goes here|Add your.*here|Fill in|Complete this)') THEN 'V14' END,
 CASE WHEN NOT regexp_matches(regexp_replace(c, '#[^\n]*', '', 'g'), 'self\.(play|add|wait|remove|bring_to_front|bring_to_back)\(') THEN 'V16' END,
 CASE WHEN NOT regexp_matches(c, '{_METHODS}') THEN 'V17' END,
 CASE WHEN NOT regexp_matches(c, '{_OBJECTS}') THEN 'V18' END,
 CASE WHEN NOT (starts_with(d, '[PENDING_DESCRIPTION]') OR starts_with(d, '[PLACEHOLDER')) AND (CASE {_SHAPE} END) IS NOT NULL THEN 'V19' END], lambda x: x IS NOT NULL) AS rules FROM r)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.expr(_DESC).alias("description"), F.expr(CODE).alias("code"))
    issues = F.concat(quality.description_issues(F.col("description")), quality.text_issues(F.col("description"), F.col("code"), {}))
    return d.select("seq", F.filter(issues, lambda i: ~i["rule"].isin("V6", "V7")).alias("issues"))


@query(f"WITH {_RULES} SELECT seq, array_to_string(rules, ',') AS rules, len(list_filter(rules, lambda x: x IN ('V2', 'V4', 'V14', 'V16'))) = 0 AS strict_ok, len(list_filter(rules, lambda x: x IN ('V2', 'V16'))) = 0 AS lenient_ok FROM i")
def quality_native_rules(spark, sf_dir):
    return _judged(spark, sf_dir).select("seq", F.array_join(F.transform("issues", lambda i: i["rule"]), ",").alias("rules"), quality.passes(F.col("issues")).alias("strict_ok"), quality.passes(F.col("issues"), False).alias("lenient_ok"))


@query(f"WITH {_RULES} SELECT CASE WHEN u IN ('V2', 'V16') THEN 'CRITICAL' WHEN u IN ('V4', 'V14') THEN 'HIGH' ELSE 'MEDIUM' END AS severity, count(*) AS n FROM (SELECT unnest(rules) AS u FROM i) GROUP BY severity")
def severity_counts(spark, sf_dir):
    return _judged(spark, sf_dir).select(F.explode("issues").alias("i")).groupBy("i.severity").agg(F.count("*").alias("n"))


@query(f"WITH {_RULES} SELECT l.quality, l.toxic, count(*) AS n, count(*) FILTER (WHERE len(list_filter(rules, lambda x: x IN ('V2', 'V16'))) = 0) AS lenient_ok FROM i JOIN labels l ON l.doc_id = i.seq GROUP BY l.quality, l.toxic")
def quality_verdict_vs_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", "seq")
    return _judged(spark, sf_dir).join(labels, "seq").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.count_if(quality.passes(F.col("issues"), False)).alias("lenient_ok"))


#: What the syntax tree says of PYTHON's forms, read off the code's lines.
_TREE = rf"""t AS (SELECT *, ok AND regexp_matches(c, '(?m)^class \w+\(Scene\):$') AS scene FROM (SELECT doc_id AS seq, c, NOT regexp_matches(c, '(?m)^class \w+\(Scene:$') AS ok FROM (SELECT doc_id, {PYTHON} AS c FROM documents)))"""


@query(
    rf"""WITH {_TREE} SELECT seq, ok, ok AND regexp_matches(c, '(?m)^from \w+ import') AS has_import, scene AS has_scene, scene AND NOT regexp_matches(c, '(?m)^    def construct\(self\):$') AS missing_construct,
 scene AND regexp_matches(c, '(?m)^    def construct\(self\):\n        (pass|\.\.\.)\n(#|$)') AS empty_construct, ok AND regexp_matches(c, '(?m)^ +\.\.\.$') AS has_ellipsis FROM t"""
)
def syntax_facts(spark, sf_dir):
    f = python_scenes(spark, sf_dir).select("seq", pycode.py_facts(F.col("code")).alias("f"))
    return f.select("seq", "f.ok", "f.has_import", (F.size("f.scene_classes") > 0).alias("has_scene"), (F.size("f.missing_construct") > 0).alias("missing_construct"), (F.size("f.empty_construct") > 0).alias("empty_construct"), "f.has_ellipsis")


@query(f"WITH {_TREE} SELECT seq, scene AND contains(c, 'def construct') AS would_render FROM t")
def render_dry_run(spark, sf_dir):
    return quality.dry_run(python_scenes(spark, sf_dir)).select("seq", "would_render")


@query()
def quality_full(spark, sf_dir):
    v = quality.validate(scenes(spark, sf_dir))
    return v.select("seq", "is_valid", F.array_join("issue_texts", "\n").alias("issues"))


@query()
def quality_report(spark, sf_dir):
    return quality.report(quality.validate(scenes(spark, sf_dir)))


@query()
def quality_failures_by_source(spark, sf_dir):
    return quality.failures_by_source(quality.validate(scenes(spark, sf_dir))).select("source", "failed", F.to_json("examples").alias("examples"))


# Code repair


#: (tag, condition on x, replacement of x), in the order of the chain; each sees what the one before left.
_STEPS = [
    ("texmobject_to_mathtex", "contains(x, 'TexMobject')", r"regexp_replace(x, '\bTexMobject\b', 'MathTex', 'g')"),
    ("textmobject_to_text", "contains(x, 'TextMobject')", r"regexp_replace(x, '\bTextMobject\b', 'Text', 'g')"),
    ("removed_tex_to_color_map", r"regexp_matches(x, 'tex_to_color_map\s*=\s*[{\w]')", r"regexp_replace(x, ',?\s*tex_to_color_map\s*=\s*(\w+|\{[^}]*\})', '', 'g')"),
    ("center_to_get_center", "contains(x, '.center[') AND NOT contains(x, '.get_center()')", "replace(x, '.center[', '.get_center()[')"),
    ("showcreation_to_create", "contains(x, 'ShowCreation')", r"regexp_replace(x, '\bShowCreation\b', 'Create', 'g')"),
    *((f"fadeinfrom{d}_to_fadein", f"contains(x, 'FadeInFrom{d.title()}')", rf"regexp_replace(x, '\bFadeInFrom{d.title()}\s*\(\s*([^)]+?)\s*\)', 'FadeIn(\1, shift={d.upper()})', 'g')") for d in ("down", "up", "left", "right")),
    *((f"{old.lower()}_to_{new.lower()}", rf"regexp_matches(x, '{old}\s*\(\s*[^,]+,\s*[^)]+\)')", rf"regexp_replace(x, '{old}\s*\(\s*([^,]+?)\s*,\s*([^)]+?)(\))?\s*\)', '{new}(\1, shift=\2\3)', 'g')") for old, new in (("FadeInFrom", "FadeIn"), ("FadeOutAndShift", "FadeOut"))),
    *((f"set_{p}_to_property", rf"regexp_matches(x, '\w\.set_{p}\([^)]+\)')", rf"regexp_replace(x, '(\w+)\.set_{p}\(\s*([^)]+?)\s*\)', '\1.{p} = \2', 'g')") for p in ("width", "height")),
    *((f"get_{p}_to_property", rf"regexp_matches(x, '\w\.get_{p}\(\s*\)')", rf"regexp_replace(x, '(\w+)\.get_{p}\(\s*\)', '\1.{p}', 'g')") for p in ("width", "height")),
]


def _stepped() -> str:
    sql = f"SELECT doc_id AS seq, {CODE} AS x, CAST([] AS VARCHAR[]) AS tags FROM documents"
    for tag, fires, then in _STEPS:
        sql = f"SELECT seq, CASE WHEN {fires} THEN {then} ELSE x END AS x, CASE WHEN {fires} THEN list_append(tags, '{tag}') ELSE tags END AS tags FROM ({sql})"
    return sql


@query(f"SELECT seq, x AS code, array_to_string(tags, ',') AS tags FROM ({_stepped()})")
def native_code_fixes(spark, sf_dir):
    fixed = scenes(spark, sf_dir).select("seq", fixes.native_fixes(F.col("code")).alias("f"))
    return fixed.select("seq", "f.code", F.array_join("f.tags", ",").alias("tags"))


@query(f"SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM ({_stepped()})) GROUP BY tag")
def fix_tag_counts(spark, sf_dir):
    tags = native_code_fixes(spark, sf_dir).select(F.split("tags", ",").alias("fixes_applied"))
    return statistics.tag_counts(tags).where("tag <> ''")


@query()
def codefix_chain(spark, sf_dir):
    f = scenes(spark, sf_dir).select("seq", fixes.fix_code(F.col("code")).alias("f"))
    return f.select("seq", "f.code", F.array_join("f.fixes", ",").alias("fixes"))


@query()
def reindent(spark, sf_dir):
    return scenes(spark, sf_dir).select("seq", fixes.reindent_code(F.col("code")).alias("code"))


@query()
def render_fix(spark, sf_dir):
    f = scenes(spark, sf_dir).select("seq", fixes.render_fix_code(F.col("code"), F.lit("NameError: ShowCreation")).alias("f"))
    return f.select("seq", "f.code", F.array_join("f.fixes", ",").alias("fixes"))


@query(f"SELECT doc_id AS seq, contains(x, 'self.play(') AS rendering_validated, false AS auto_fixed, CASE WHEN contains(x, 'self.play(') THEN NULL ELSE 'NameError' END AS render_error FROM (SELECT doc_id, {CODE} AS x FROM documents)")
def render_samples(spark, sf_dir):
    done = quality.render(scenes(spark, sf_dir).select("seq", "code"), lambda code: ("self.play(" in code, None if "self.play(" in code else "NameError"))
    return done.select("seq", "rendering_validated", "auto_fixed", "render_error")


_VOICE = "concat('from manim import *', chr(10), 'class V', doc_id, '(VoiceoverScene):', chr(10), '    def construct(self):', chr(10), '        with self.voiceover(text=\"', replace(replace(text, chr(10), ' '), '\"', ''), '\") as tracker:', chr(10), '            self.play(Create(Circle()))', chr(10), '        self.wait()', chr(10))"


_TOLD = "replace(replace(text, chr(10), ' '), '\"', '')"


@query(
    f"""SELECT doc_id AS seq, CAST(1 AS INTEGER) AS blocks, CAST(1 AS INTEGER) AS classes, concat('from manim import *', chr(10), 'class V', doc_id, '(Scene):', chr(10), '    def construct(self):', chr(10), '        # Narration: ', left(trim(t), 100), chr(10), '        self.play(Create(Circle()))', chr(10),
 '        self.wait(', CAST(round(greatest(0.5, least(5.0, len(list_filter(string_split(t, ' '), lambda w: w <> '')) * 60 / CAST(150 AS DOUBLE))), 1) AS VARCHAR), ')', chr(10), '        self.wait()', chr(10)) AS code FROM (SELECT doc_id, {_TOLD} AS t FROM documents)"""
)
def voiceover_convert(spark, sf_dir):
    v = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), fixes.plain_scene_code(F.expr(_VOICE)).alias("f"))
    return v.select("seq", "f.code", "f.blocks", "f.classes")


@query(f"SELECT doc_id AS seq, CAST(1 AS INTEGER) AS blocks, CAST(len(list_filter(regexp_split_to_array(replace(replace(text, chr(10), ' '), '\"', ''), '\\s+'), lambda w: w <> '')) AS INTEGER) AS words FROM documents")
def voiceover_stats(spark, sf_dir):
    v = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.expr(_VOICE).alias("code"))
    return statistics.voiceover_stats(v).select("seq", "blocks", "words")


_ASSET = "concat(CASE doc_id % 8 WHEN 0 THEN 'farmer_' WHEN 1 THEN 'x_euler' WHEN 2 THEN 'my_house' WHEN 3 THEN 'leq' WHEN 4 THEN 'truck-' WHEN 5 THEN 'assets/' ELSE 'green_field_' END, CASE WHEN doc_id % 8 IN (1, 2, 3) THEN '' ELSE CAST(length(text) AS STRING) END, CASE doc_id % 8 WHEN 1 THEN '.jpg' WHEN 2 THEN '.svg' WHEN 3 THEN '.svg' ELSE '.png' END)"


@query(
    rf"""SELECT strategy, count(*) AS n FROM (SELECT CASE WHEN contains(a, 'farmer') THEN 'character' WHEN suffix(a, 'euler.jpg') THEN 'portrait' WHEN suffix(a, 'house.svg') THEN 'building' WHEN suffix(a, 'leq.svg') THEN 'math_symbol'
 WHEN contains(a, 'truck') THEN 'vehicle' WHEN regexp_matches(a, '(farm|field|landscape).*\.png') THEN 'background' ELSE 'generic_shape' END AS strategy FROM (SELECT {_ASSET} AS a FROM documents)) GROUP BY strategy"""
)
def asset_strategy(spark, sf_dir):
    return documents(spark, sf_dir).groupBy(pycode.asset_strategy(F.expr(_ASSET)).alias("strategy")).agg(F.count("*").alias("n"))


@query()
def asset_replace(spark, sf_dir):
    code = F.concat(F.lit('x = ImageMobject("'), F.expr(_ASSET), F.lit('").scale(2)\n'), F.expr(_COMMENT))
    f = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), pycode.rewrite_code(code, "assets").alias("f"))
    return f.select("seq", "f.code", F.array_join("f.replaced", ",").alias("replaced"))


@query()
def animation_unpack(spark, sf_dir):
    code = F.concat(F.lit("self.play(*xs, run_time="), F.length("text").cast("string"), F.lit(")\n"), F.expr(_COMMENT))
    return documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), pycode.rewrite_code(code, "unpack")["code"].alias("code"))


@query()
def dependency_bundle(spark, sf_dir):
    d = documents(spark, sf_dir)
    code = F.expr(f"concat('class A(Scene):', chr(10), '    def construct(self):', chr(10), '        f', length(text) % 3, '()', chr(10), {_COMMENT})")
    used = d.select(F.col("source").alias("dir"), F.col("doc_id").alias("seq"), code.alias("code"))
    utilities = d.select(F.col("source").alias("dir")).distinct().withColumn("content", F.lit("def g():\n    return 1\n\ndef f0():\n    return g()\n\ndef f1():\n    return 2\n\nK = 3\n\ndef f2():\n    return K\n"))
    return files.bundled(used, utilities).select("seq", "code", F.array_join("bundled_dependencies", ",").alias("names"))


# Counts and distributions

_L = "length(text)"


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    kept = s.join(exact_dedup_survivors(spark, sf_dir), "seq", "left_semi")
    return statistics.stage_counts({"initial_extraction": s, "after_quality": s.where(quality.basic(F.col("code"), F.col("description"))), "after_deduplication": kept})


_STAGES = f"WITH {_KEPT}, c AS (SELECT d.source, count(*) AS initial_extraction, count(*) FILTER (WHERE length(text) >= 20 AND length(text) >= 5) AS after_quality, count(kept.seq) AS after_deduplication FROM documents d LEFT JOIN kept ON kept.seq = d.doc_id GROUP BY d.source)"


@query(f"{_STAGES} SELECT * FROM c")
def stage_counts_pivot(spark, sf_dir):
    return _stages(spark, sf_dir)


@query(f"{_STAGES} SELECT source, CAST(sum(initial_extraction) AS BIGINT) AS initial_extraction, CAST(sum(after_quality) AS BIGINT) AS after_quality, CAST(sum(after_deduplication) AS BIGINT) AS after_deduplication, round((sum(initial_extraction) - sum(after_deduplication)) * 100.0 / sum(initial_extraction), 6) AS reduction_pct FROM c GROUP BY ROLLUP (source)")
def reduction_rates_rollup(spark, sf_dir):
    return statistics.with_totals(_stages(spark, sf_dir), "initial_extraction", "after_deduplication").withColumn("reduction_pct", F.round("reduction_pct", 6))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'src_none', 0")
def source_distribution_zero_filled(spark, sf_dir):
    s = samples(spark, sf_dir)
    named = s.select(F.col("source").alias("source_id")).distinct().unionByName(spark.createDataFrame([("src_none",)], "source_id string"))
    return statistics.source_distribution(s, named)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5")
def top_sources(spark, sf_dir):
    return statistics.top_sources(samples(spark, sf_dir))


@query(f"SELECT count(*) AS n, CAST(median({_L}) AS DOUBLE) AS median, round(avg({_L}), 6) AS mean, CAST(min({_L}) AS INTEGER) AS least, CAST(max({_L}) AS INTEGER) AS most, round(stddev_pop({_L}), 6) AS deviation FROM documents")
def length_stats(spark, sf_dir):
    t = statistics.length_stats(samples(spark, sf_dir), F.length("code"))
    return t.withColumns({"mean": F.round("mean", 6), "deviation": F.round("deviation", 6)})


@query(f"SELECT source, count(*) AS n, CAST(sum({_L}) AS BIGINT) AS total, CAST(median({_L}) AS DOUBLE) AS median, round(avg({_L}), 6) AS mean FROM documents GROUP BY source")
def length_stats_by_source(spark, sf_dir):
    return statistics.length_stats_by_source(samples(spark, sf_dir), F.length("code")).withColumn("mean", F.round("mean", 6))


@query(f"SELECT source, CAST(quantile_cont({_L}, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont({_L}, 0.5) AS DOUBLE) AS q2, CAST(quantile_cont({_L}, 0.75) AS DOUBLE) AS q3 FROM documents GROUP BY source HAVING max({_L}) > 0")
def length_quartiles(spark, sf_dir):
    return statistics.quartiles_by_source(samples(spark, sf_dir), F.length("code"))


_BUCKET = f"CASE WHEN {_L} < 500 THEN 0 WHEN {_L} < 1000 THEN 1 WHEN {_L} < 1500 THEN 2 WHEN {_L} < 2000 THEN 3 WHEN {_L} < 2500 THEN 4 WHEN {_L} < 3000 THEN 5 WHEN {_L} < 5000 THEN 6 ELSE 7 END"


@query(f"SELECT CAST({_BUCKET} AS INTEGER) AS bucket, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY bucket")
def length_buckets(spark, sf_dir):
    return statistics.length_buckets(samples(spark, sf_dir), F.length("code")).withColumn("pct", F.round("pct", 6).cast("double"))


@query(f"SELECT source, {', '.join(f'count(*) FILTER (WHERE {_BUCKET} = {i}) AS b{i}' for i in range(8))} FROM documents GROUP BY source")
def source_by_bucket(spark, sf_dir):
    return statistics.source_by_bucket(samples(spark, sf_dir), F.length("code"))


@query(f"SELECT source, CAST(x AS INTEGER) AS x, n, round((u - n + 1) / CAST(t AS DOUBLE), 9) AS low, round(u / CAST(t AS DOUBLE), 9) AS share FROM (SELECT source, x, n, sum(n) OVER (PARTITION BY source ORDER BY x) AS u, sum(n) OVER (PARTITION BY source) AS t FROM (SELECT source, {_L} AS x, count(*) AS n FROM documents GROUP BY source, x))")
def length_cdf(spark, sf_dir):
    return statistics.length_cdf(samples(spark, sf_dir), F.length("code")).withColumns({"low": F.round("low", 9), "share": F.round("share", 9)})


@query("SELECT source, doc_id AS seq FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 10")
def first_n_per_source(spark, sf_dir):
    return statistics.first_n(samples(spark, sf_dir).select("source", "seq"), "source", "seq", 10)


# Split, conversations, sources


@query("SELECT doc_id AS seq, text AS description, text AS code, source, CASE WHEN (row_number() OVER (ORDER BY doc_id) - 1) % 10 = 9 THEN 'test' ELSE 'train' END AS split FROM documents")
def modulo_split(spark, sf_dir):
    return split.modulo_split(samples(spark, sf_dir))


@query("SELECT 'test' AS split, CAST(floor(count(*) * 0.1) AS BIGINT) AS n FROM documents UNION ALL SELECT 'train', count(*) - CAST(floor(count(*) * 0.1) AS BIGINT) FROM documents")
def split_counts(spark, sf_dir):
    return split.exact_split(samples(spark, sf_dir).select("seq")).groupBy("split").agg(F.count("*").alias("n"))


_DRAW = "CAST(concat('0x', left(md5(concat(doc_id, ':42')), 8)) AS BIGINT)"


@query("SELECT doc_id AS seq, CASE WHEN row_number() OVER (ORDER BY md5(concat(doc_id, ':42')), doc_id) <= floor((SELECT count(*) FROM documents) * 0.1) THEN 'test' ELSE 'train' END AS split FROM documents")
def hash_split(spark, sf_dir):
    return split.exact_split(samples(spark, sf_dir).select("seq"))


@query(f"SELECT seq, CAST(k AS BIGINT) AS variant, {_PROMPT} AS description FROM (SELECT doc_id AS seq, text AS d, {_LOWERED} AS l, unnest(range(2 + {_DRAW} % 2)) AS k FROM documents)")
def augmented_train(spark, sf_dir):
    return split.augmented(samples(spark, sf_dir)).select("seq", "variant", "description")


@query("SELECT conv_id, count(*) AS turns, string_agg(role || ':' || text, chr(10) ORDER BY turn, role, text) AS joined FROM conversations GROUP BY conv_id")
def conversation_assemble(spark, sf_dir):
    c = split.from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return c.select("conv_id", F.size("conversations").cast("long").alias("turns"), F.array_join(F.transform("conversations", lambda t: F.concat(t["from"], F.lit(":"), t["value"])), "\n").alias("joined"))


@query("SELECT conv_id, v[2] AS description, v[3] AS code FROM (SELECT conv_id, list(text ORDER BY turn, role, text) AS v FROM conversations GROUP BY conv_id) WHERE len(v) >= 3")
def conversation_pairs(spark, sf_dir):
    return split.question_answer(split.from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).select("conv_id", "description", "code")


@query(f"SELECT doc_id AS seq, concat('```python', chr(10), {_ENSURED}, chr(10), '```') AS answer FROM {_STRIPPED}")
def conversation_records(spark, sf_dir):
    turns = split.conversation(F.col("description"), F.col("code"))
    return scenes(spark, sf_dir).select("seq", F.get(turns, F.lit(2))["value"].alias("answer"))


_NAMED = f"concat('from manim import *', chr(10), 'class A', length(text) % 100, '(Scene):', chr(10), '    pass', chr(10), {_COMMENT})"


@query(f"SELECT seq, CASE WHEN r = 1 THEN x ELSE replace(x, concat('class ', name, '('), concat('class ', name, 'V', r, '(')) END AS code FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY seq) AS r FROM (SELECT doc_id AS seq, x, regexp_extract(x, 'class (\\w+)\\(', 1) AS name FROM (SELECT doc_id, {_NAMED} AS x FROM documents)))")
def class_conflict_rename(spark, sf_dir):
    d = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.expr(_NAMED).alias("code"))
    return tables.unique_scene_names(d).select("seq", "code")


@query("SELECT doc_id AS seq FROM documents WHERE source NOT IN ('src0', 'src1')")
def source_exclusion(spark, sf_dir):
    out = spark.createDataFrame([("src0",), ("src1",)], "source string")
    return samples(spark, sf_dir).join(out, "source", "left_anti").select("seq")


@query("SELECT doc_id AS seq FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def keep_listed(spark, sf_dir):
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select(F.col("doc_id").alias("seq"))
    return split.keep_listed(samples(spark, sf_dir), good).select("seq")


@query("SELECT doc_id AS seq, CASE WHEN doc_id % 4 = 0 THEN concat('made of ', length(text)) ELSE 'kept' END AS description FROM documents")
def description_cache_fill(spark, sf_dir):
    s = documents(spark, sf_dir).select(F.col("doc_id").alias("seq"), F.when(F.col("doc_id") % 4 == 0, text.PENDING).otherwise("kept as it is, no change").alias("description"), F.concat(F.length("text").cast("string"), F.lit("|"), F.col("text")).alias("code"), "source")
    known = descriptions.keyed(s.where("source = 'src1'")).select(F.col("cache_key").alias("key"), F.concat(F.lit("made of "), F.substring_index("code", "|", 1)).alias("description")).distinct()
    filled, _ = descriptions.fill(s, known, lambda codes: [f"made of {c.split('|')[0]}" for c in codes])
    return filled.select("seq", F.when(F.col("description").startswith("kept"), "kept").otherwise(F.col("description")).alias("description"))


@query("SELECT count(*) AS entries, CAST(coalesce(sum(strlen(d)), 0) AS BIGINT) AS bytes FROM (SELECT DISTINCT text, text AS d FROM documents)")
def description_cache_stats(spark, sf_dir):
    return descriptions.cache_stats(samples(spark, sf_dir).select("code", "description").distinct())


@query(
    """SELECT CAST(idx // 5 AS BIGINT) AS batch, concat('Describe each animation in one sentence. Answer with a JSON array of strings.', chr(10), chr(10), string_agg(concat('[', idx, ']', chr(10), left(text, 500)), concat(chr(10), chr(10)) ORDER BY idx)) AS prompt
FROM (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents) GROUP BY idx // 5"""
)
def description_prompts(spark, sf_dir):
    return descriptions.prompts(samples(spark, sf_dir))


@query("SELECT doc_id AS batch, CAST(0 AS INTEGER) AS pos, CASE WHEN doc_id % 2 = 0 THEN source ELSE '[GENERATION_FAILED]' END AS description FROM documents UNION ALL SELECT doc_id, 1, text FROM documents WHERE doc_id % 2 = 0")
def answer_parsing(spark, sf_dir):
    answers = samples(spark, sf_dir).select(F.col("seq").alias("batch"), F.when(F.col("seq") % 2 == 0, F.concat(F.lit("Sure: "), F.to_json(F.array("source", "description")))).otherwise("none").alias("answer"))
    return descriptions.parse_answers(answers)


_PAGE = "concat('<section id=\"animations\"><div class=\"highlight-python notranslate\"><pre>', replace(replace(CODE, '<', '&lt;'), '>', '&gt;'), '</pre></div></section><pre>no</pre>')"


@query(f"SELECT doc_id AS seq, concat('S', doc_id) AS name, 'Animations' AS category, x AS code FROM {_STRIPPED} WHERE length(x) >= 50 AND regexp_matches(x, 'class\\s+\\w+\\s*\\(')")
def html_examples(spark, sf_dir):
    d = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("url"), F.expr(_PAGE.replace("CODE", CODE)).alias("html"))
    return files.pages_to_samples(d).select(F.col("path").cast("long").alias("seq"), "name", "category", "code")


_EXAMPLE = "concat('class P', page_id, '(Scene):', chr(10), '    def construct(self):', chr(10), '        self.play(Write(Text(\"', length(html), '\")))')"
_WITH_EXAMPLE = f"concat(html, '<section id=\"plotting-with-manim\"><div class=\"notranslate highlight-python\"><div><pre>', {_EXAMPLE}, '</pre></div></div></section><pre>class Q(Scene): no example</pre>')"


@query(f"SELECT url AS path, concat('P', page_id) AS name, 'Plotting' AS category, {_EXAMPLE} AS code FROM pages")
def page_examples(spark, sf_dir):
    """Real pages with one example at the end of each."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", F.expr(_WITH_EXAMPLE).alias("html"))
    return files.pages_to_samples(p).select("path", "name", "category", "code")


@query()
def notebook_cells(spark, sf_dir):
    cell = lambda kind, body: F.struct(F.lit(kind).alias("cell_type"), F.array(body).alias("source"))
    book = F.to_json(F.struct(F.array(cell("code", F.lit("from manim import *")), cell("markdown", F.concat(F.lit("# "), F.col("description"))), cell("code", F.col("code"))).alias("cells")))
    d = scenes(spark, sf_dir).select(F.col("seq").cast("string").alias("path"), book.alias("content"))
    return files._expand(d, files.notebook_samples, "pos long, name string, description string, code string")


@query(rf"SELECT CAST(doc_id AS VARCHAR) AS path, concat('S', doc_id) AS name, regexp_extract(x, '(?s)(class S\d+\(Scene\):.*?)\n# ', 1) AS code, CAST(NULL AS VARCHAR) AS docstring FROM (SELECT doc_id, {CODE} AS x FROM documents) WHERE regexp_matches(x, '(?m)^class S\d+\(Scene\):$')")
def scene_classes(spark, sf_dir):
    d = scenes(spark, sf_dir).select(F.col("seq").cast("string").alias("path"), F.col("code").alias("content"))
    return files._expand(d, pycode.scene_sources, "name string, code string, docstring string")


@query("WITH q AS (SELECT quantile_disc(length(text), [0.25, 0.5, 0.75]) AS c FROM documents) SELECT doc_id AS seq, CAST(length(text) > c[1] AS INTEGER) + CAST(length(text) > c[2] AS INTEGER) + CAST(length(text) > c[3] AS INTEGER) AS level FROM documents, q")
def curriculum_levels(spark, sf_dir):
    return split.curriculum(samples(spark, sf_dir), F.length("code")).select("seq", "level")


@query(f"SELECT doc_id AS seq, source, text AS code FROM documents WHERE {_DRAW} % 1000000 / CAST(1000000 AS DOUBLE) < CASE source WHEN 'src0' THEN 0.2 WHEN 'src1' THEN 0.5 ELSE 1 END")
def weighted_sample(spark, sf_dir):
    return split.weighted_sample(samples(spark, sf_dir), {"src0": 0.2, "src1": 0.5}).select("seq", "source", "code")


def source_dimension(spark: SparkSession) -> DataFrame:
    REGISTRY.discover()
    return REGISTRY.dimension(spark)
