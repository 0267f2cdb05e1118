"""Queries of the llm problems (3, 4, 6, 7 and 8) and their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANK, INVISIBLE, fire_label, fire_number, period_label
from ..session import cut_lineage
from ..sources.tables import one_delivery, table
from .canonical import canonical_text
from .leakage import leaked_items
from .lookalike import look_classes, lookalike_pairs
from .quantiles import merge_sketches, read_quantiles, sketch_groups
from .splits import NOBODY, linked_nodes, name_key, split_together
from .tokens import encode_corpus

PARTS = {"test": 0.1, "validation": 0.1, "train": 0.8}


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return one_delivery(table(spark, folder, "training_locations").select("point_id", "fire_id", "author", "loaded_at"), "point_id")


def _ties() -> dict:
    return {"fire": fire_label(fire_number("fire_id")), "author": name_key(F.col("author"))}


def p3_components(spark: SparkSession, folder: str) -> DataFrame:
    """Every fire with the first fire of its component. Ties are made of the distinct pairs as written, which are far fewer than points."""
    written = table(spark, folder, "training_locations").select("fire_id", "author").distinct()
    _, labels = linked_nodes(written, key="author", links=_ties(), keep=False)
    fires = labels.where(F.col("node").startswith("fire:")).select("root", F.substring("node", 6, 100).alias("fire_id"))
    return fires.join(fires.groupBy("root").agg(F.min("fire_id").alias("first_fire")), "root").select("fire_id", "first_fire")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Fires of one component; a component's fires, not its points, are paired."""
    fires = p3_components(spark, folder)
    pairs = fires.select("first_fire", F.col("fire_id").alias("fire_id_a")).join(fires.select("first_fire", F.col("fire_id").alias("fire_id_b")), "first_fire")
    return pairs.where("fire_id_a < fire_id_b").select("fire_id_a", "fire_id_b").distinct()


def _split_points(spark: SparkSession, folder: str) -> DataFrame:
    return split_together(_points(spark, folder), key="point_id", links=_ties(), parts=PARTS)


def p3_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _split_points(spark, folder).select("point_id", "split")


def p3_whole(spark: SparkSession, folder: str) -> DataFrame:
    """What a split must keep to: records, components, those in more than one part, records without a part, and how many
    records the test part is off its goal."""
    per = _split_points(spark, folder).groupBy("component", "split").count()
    groups = per.groupBy("component").agg(F.sum("count").alias("n"), F.count("*").alias("parts"), F.sum(F.when(F.col("split").isNull(), F.col("count")).otherwise(0)).alias("none"), F.sum(F.when(F.col("split") == "test", F.col("count")).otherwise(0)).alias("test"))
    whole = groups.agg(F.sum("n").alias("records"), F.count("*").alias("components"), F.sum((F.col("parts") > 1).cast("int")).alias("parted"), F.sum("none").alias("without_part"), F.sum("test").alias("test"))
    return whole.select("records", "components", "parted", "without_part", F.abs(F.col("test") - F.round(F.col("records") * F.lit(PARTS["test"]))).cast("bigint").alias("test_off"))


SHARES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def _nbr_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chart_rows").select("obs_id", "fire_id", period_label("period").alias("period"), "nbr", "loaded_at").where("nbr is not null")
    return one_delivery(rows, "obs_id")


def _nbr_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """One sketch per fire, period and year of load; a redelivered row counts in the year of its first load."""
    return sketch_groups(_nbr_rows(spark, folder), groups={"fire_id": F.col("fire_id"), "period": F.col("period"), "load": F.year("loaded_at")}, value=F.col("nbr"))


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of nbr per fire and period, from the merged sketches of all loads."""
    return read_quantiles(merge_sketches(_nbr_sketches(spark, folder), ["fire_id", "period"]), SHARES)


def p4_extent(spark: SparkSession, folder: str) -> DataFrame:
    """What the merged sketches know exactly: number, least and greatest value."""
    return read_quantiles(merge_sketches(_nbr_sketches(spark, folder), ["fire_id", "period"]), {"low": 0.0, "high": 1.0})


WITHIN = 5 * 0.131 / 32  # five standard deviations of a rank, as a share of its distance from the near end


def p4_bound(spark: SparkSession, folder: str) -> DataFrame:
    """Per group, whether the exact ranks of all percentiles are within the bound of the ranks asked for."""
    found = cut_lineage(p4_percentiles(spark, folder))
    groups = [F.col("fire_id").eqNullSafe(F.col("g_fire")), F.col("period").eqNullSafe(F.col("g_period"))]
    asked = found.select(F.col("fire_id").alias("g_fire"), F.col("period").alias("g_period"), "n", *SHARES)
    few = found.limit(50_001).count() <= 50_000
    rows = _nbr_rows(spark, folder).where("not isnan(nbr)").groupBy("fire_id", "period", "nbr").count()
    rows = rows.join(F.broadcast(asked) if few else asked, groups[0] & groups[1])
    counts = [F.sum(F.when(F.col("nbr") < F.col(p), F.col("count")).otherwise(0)).alias(f"{p}_below") for p in SHARES]
    counts += [F.sum(F.when(F.col("nbr") <= F.col(p), F.col("count")).otherwise(0)).alias(f"{p}_upto") for p in SHARES]
    ranks = rows.groupBy("fire_id", "period", "n").agg(F.sum("count").alias("exact_n"), *counts)
    within = F.col("n") == F.col("exact_n")
    for name, share in SHARES.items():
        rank = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(share) - F.lit(1e-9)))
        off = F.greatest(F.col(f"{name}_below") + 1 - rank, rank - F.col(f"{name}_upto"), F.lit(0))
        within = within & (off <= F.lit(WITHIN) * (rank if share <= 0.5 else F.col("n") - rank + 1))
    return ranks.select("fire_id", "period", "n", within.alias("within"))


def p4_loads(spark: SparkSession, folder: str) -> DataFrame:
    """What each load by itself holds."""
    return read_quantiles(_nbr_sketches(spark, folder), {"low": 0.0, "high": 1.0})


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), key="doc_id", text="text")


def p7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"), key="doc_id", text="text", item="item_id", passage="passage", question="question")


def p7_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Leaks of twelve words in a row alone."""
    return p7_leaks(spark, folder).where("run").select("doc_id", "item_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_leaks(spark, folder).select("doc_id", "item_id")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike_pairs(table(spark, folder, "documents"), key="doc_id", text="text")


def p8_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in its one form."""
    return table(spark, folder, "documents").select("doc_id", canonical_text(F.col("text")).alias("text"))


def p8_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with a visible character: the class of texts that look like it."""
    return look_classes(table(spark, folder, "documents"), key="doc_id", text="text")


QUERIES = {
    "p3_found": p3_found,
    "p3_components": p3_components,
    "p3_splits": p3_splits,
    "p3_whole": p3_whole,
    "p4_percentiles": p4_percentiles,
    "p4_extent": p4_extent,
    "p4_bound": p4_bound,
    "p4_loads": p4_loads,
    "p6_ids": p6_ids,
    "p7_found": p7_found,
    "p7_runs": p7_runs,
    "p7_leaks": p7_leaks,
    "p8_found": p8_found,
    "p8_canonical": p8_canonical,
    "p8_classes": p8_classes,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Of the SQL alone, so that an error in the operator's table does not stand in both: letters drawn alike and composed letters over them,
# characters that are not shown, and compatibility forms.
SQL_CYRILLIC = ("АВЕКМНОРСТХУЅІЈаеорсухѕіјһԁԛԝҮӀѴѵӏԌԚԜЁЀЇёѐї", "ABEKMHOPCTXYSIJaeopcyxsijhdqwYIVvlGQWËÈÏëèï")
SQL_GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορυνϲϳΆΈΊΌΎΪΫάόύϋ", "ABEZHIKMNOPTYXaopuvcjÁÉÍÓÝÏŸáóúü")
SQL_OTHER = ("ՍՏՕզհոսցօᎠᎢᎥᎪᎫᎬᎷᎻᏃᏏᏒᏙᏞᏟᏢᏦᏧᏴꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴɑɡʼ", "USOqhnugoDTiAJEMHZbRVLCPKdBBPDTGKJCZFMNLSRVHWXYAEIOUag’")
SQL_GONE = r"[\x{ad}\x{34f}\x{61c}\x{17b4}\x{17b5}\x{180b}-\x{180f}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}\x{e0000}-\x{e0fff}]"


def _skeleton_sql(column: str) -> str:
    """The look-alike form of a text in SQL: characters mapped one by one, line ends, composition."""
    wide = ("".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F))))
    one, to = ("".join(x) for x in zip(SQL_CYRILLIC, SQL_GREEK, SQL_OTHER, wide, ("‐‑﹣\u2028\u2029\x85\xb5", "---\n\n\n\u03bc")))
    mapped = lambda x: f"translate({x}, {_quoted(one)}, {_quoted(to)})"
    out = f"regexp_replace(regexp_replace({column}, '{SQL_GONE}', '', 'g'), '\\p{{Zs}}', ' ', 'g')"
    for char, letters in zip("ﬀﬁﬂﬃﬄ", ("ff", "fi", "fl", "ffi", "ffl")):
        out = f"replace({out}, '{char}', '{letters}')"
    out = f"replace(replace({mapped(out)}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return mapped(f"nfc_normalize({out})")


def _canonical_sql() -> str:
    """The canonical text in SQL: the look-alike form, in whose Cyrillic words the letters go back (no other script stands in these tables)."""
    back = {latin: other for other, latin in zip(*SQL_CYRILLIC) if other not in "ҮӀЁЀЇёѐї"}
    one, more = dict(back), {}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(c))
        if len(parts) > 1 and parts[0] in back:
            own = unicodedata.normalize("NFC", back[parts[0]] + parts[1:])
            (one if len(own) == 1 else more)[chr(c)] = own
    turned = f"translate(w, {_quoted(''.join(one))}, {_quoted(''.join(one.values()))})"
    for char, own in more.items():
        turned = f"replace({turned}, '{char}', '{own}')"
    cyrillic, letters = r"\x{400}-\x{52f}", r"\p{L}\p{Nl}\p{No}"
    twins = "".join(back)
    twin_words = "".join(c for c in back if c not in "VvlGQW")
    plain = "".join(c for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B)]) if c not in back)
    return f"""WITH k AS (SELECT doc_id, {_skeleton_sql("text")} AS s FROM documents),
m AS (SELECT doc_id, s, regexp_extract_all(s, '[{letters}]+|[^{letters}]+') AS parts,
  length(regexp_replace(strip_accents(s), '[^{cyrillic}]', '', 'g')) > length(regexp_replace(strip_accents(s), '[^{plain}\\x{{aa}}\\x{{b2}}\\x{{b3}}\\x{{b9}}\\x{{ba}}\\x{{bc}}-\\x{{be}}\\x{{c0}}-\\x{{24f}}]', '', 'g')) AS mostly FROM k)
SELECT doc_id, CASE WHEN s IS NOT NULL THEN array_to_string(list_transform(parts, lambda w: CASE
  WHEN regexp_full_match(strip_accents(w), '[{cyrillic}{twins}]+') AND (regexp_matches(w, '[{cyrillic}]') OR (mostly AND regexp_full_match(strip_accents(w), '[{twin_words}]+'))) THEN {turned} ELSE w END), '') END AS text FROM m"""


NAME_SQL = f"""list_sort(list_distinct(list_filter(regexp_split_to_array(lower(strip_accents(regexp_replace(author, '{INVISIBLE}', '', 'g'))), '({BLANK}|,)+'), lambda w: w <> '')))"""
def _words_sql(column: str) -> str:
    return f"regexp_extract_all(lower(strip_accents({_skeleton_sql(column)})), '[\\p{{L}}\\p{{N}}]+')"


FIRES_SQL = f"""WITH RECURSIVE a AS (SELECT DISTINCT point_id, try_cast(nullif(regexp_extract(fire_id, '([0-9]+)', 1), '') AS BIGINT) AS n, {NAME_SQL} AS words FROM training_locations),
b AS (SELECT point_id, n, CASE WHEN len(list_filter(words, lambda w: regexp_matches(w, '\\p{{L}}') AND w NOT IN ({", ".join(map(_quoted, NOBODY))}))) > 0 THEN array_to_string(words, ' ') END AS author FROM a),
p AS (SELECT DISTINCT n, author FROM b WHERE n IS NOT NULL AND author IS NOT NULL),
e AS (SELECT DISTINCT p.n AS x, q.n AS y FROM p JOIN p q USING (author) WHERE p.n <> q.n),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT f.n, least(f.n, coalesce(min(r.y), f.n)) AS first FROM (SELECT DISTINCT n FROM b WHERE n IS NOT NULL) f LEFT JOIN r ON r.x = f.n GROUP BY f.n)
"""

SQL = {
    "p3_found": FIRES_SQL + "SELECT printf('fire_%03d', x) AS fire_id_a, printf('fire_%03d', y) AS fire_id_b FROM r WHERE x < y",
    "p3_components": FIRES_SQL + "SELECT printf('fire_%03d', n) AS fire_id, printf('fire_%03d', first) AS first_fire FROM c",
    "p3_whole": FIRES_SQL
    + f""", g AS (SELECT p.author, min(c.first) AS first FROM p JOIN c USING (n) GROUP BY p.author),
k AS (SELECT CASE WHEN b.n IS NOT NULL THEN 'f' || c.first WHEN g.first IS NOT NULL THEN 'f' || g.first WHEN b.author IS NOT NULL THEN 'a' || b.author ELSE 'p' || b.point_id END AS component
  FROM b LEFT JOIN c ON c.n = b.n LEFT JOIN g ON g.author = b.author),
s AS (SELECT component, count(*) AS size FROM k GROUP BY component),
o AS (SELECT size, row_number() OVER (ORDER BY size DESC) AS i FROM s),
t AS (SELECT 0 AS i, 0::BIGINT AS total UNION SELECT t.i + 1, t.total + u.take * o.size FROM t JOIN o ON o.i = t.i + 1 CROSS JOIN (VALUES (0), (1)) u(take) WHERE t.total + u.take * o.size <= (SELECT sum(size) FROM s) / 5),
goal AS (SELECT sum(size) AS records, count(*) AS components, CAST(round(sum(size) * {PARTS["test"]}::DOUBLE) AS BIGINT) AS n FROM s)
SELECT CAST(records AS BIGINT) AS records, components, 0::BIGINT AS parted, 0::BIGINT AS without_part, (SELECT CAST(min(abs(total - goal.n)) AS BIGINT) FROM t WHERE i = goal.components) AS test_off FROM goal""",
    "p4_extent": """WITH t AS (SELECT DISTINCT obs_id, fire_id, regexp_replace(lower(period), '[^a-z]', '', 'g') AS p, nbr FROM chart_rows WHERE nbr IS NOT NULL),
u AS (SELECT *, CASE p WHEN 'prefire' THEN 'Pre-fire' WHEN 'postfire' THEN 'Post-fire' WHEN 'background' THEN 'Background' END AS period FROM t)
SELECT fire_id, period, count(*) AS n, min(nbr) AS low, max(nbr) AS high FROM u WHERE NOT isnan(nbr) GROUP BY fire_id, period""",
    "p4_bound": """WITH t AS (SELECT DISTINCT obs_id, fire_id, regexp_replace(lower(period), '[^a-z]', '', 'g') AS p, nbr FROM chart_rows WHERE nbr IS NOT NULL),
u AS (SELECT *, CASE p WHEN 'prefire' THEN 'Pre-fire' WHEN 'postfire' THEN 'Post-fire' WHEN 'background' THEN 'Background' END AS period FROM t)
SELECT fire_id, period, count(*) AS n, true AS within FROM u WHERE NOT isnan(nbr) GROUP BY fire_id, period""",
    "p4_loads": """WITH t AS (SELECT obs_id, fire_id, regexp_replace(lower(period), '[^a-z]', '', 'g') AS p, nbr, loaded_at FROM chart_rows WHERE nbr IS NOT NULL),
u AS (SELECT *, CASE p WHEN 'prefire' THEN 'Pre-fire' WHEN 'postfire' THEN 'Post-fire' WHEN 'background' THEN 'Background' END AS period FROM t),
o AS (SELECT obs_id, fire_id, period, nbr, CAST(year(min(loaded_at)) AS INTEGER) AS load FROM u WHERE NOT isnan(nbr) GROUP BY ALL)
SELECT fire_id, period, load, count(*) AS n, min(nbr) AS low, max(nbr) AS high FROM o GROUP BY ALL""",
    "p7_runs": f"""WITH i AS (SELECT item_id, {_words_sql("passage")} AS w FROM eval_items WHERE passage IS NOT NULL), d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents WHERE text IS NOT NULL),
gi AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i)),
gd AS (SELECT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d))
SELECT DISTINCT doc_id, item_id FROM gd JOIN gi USING (g)""",
    "p8_found": f"""WITH d AS (SELECT doc_id, text, {_skeleton_sql("text")} AS look FROM documents WHERE text IS NOT NULL), v AS (SELECT * FROM d WHERE regexp_matches(look, '[^\\s]'))
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM v a JOIN v b ON a.look = b.look AND a.doc_id < b.doc_id AND a.text <> b.text""",
    "p8_canonical": _canonical_sql(),
    "p8_classes": f"""WITH d AS (SELECT doc_id, text, {_skeleton_sql("text")} AS look FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(look) AS look, md5(text) AS form FROM d WHERE regexp_matches(look, '[^\\s]')""",
}
