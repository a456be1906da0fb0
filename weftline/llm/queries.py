"""Registered queries of the training-data operators, with SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    crosstoken,
    decontaminate,
    divergence,
    exactdedup,
    html_text,
    licenses,
    linededup,
    mixing,
    neardup,
    pii,
    quality,
    secrets,
    simhash,
)
from weftline.plans.runtime import read_table, spread

#: A key for the registered query; whoever shares results sets their own.
PII_KEY = "example key, replace in production"
LINE_WORDS = 50
QUALITY_THRESHOLD = 0.3
#: Shares of the mix: the large source gives way to the others, languages are levelled.
TARGETS = mixing.MixTargets(
    source={"src0": 0.25, mixing.REST: 0.75},
    lang={"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.1, mixing.REST: 0.05},
    topic={"computing": 0.04, "law": 0.06, mixing.REST: 0.9},
    keep=0.7,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise_documents(_documents(spark, sf_dir), PII_KEY)
    counts = [_count(k) for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.size("found").cast("long").alias("n_pii"),
        _spans(F.col("found"), "kind").alias("spans"),
        "text",
    )


def _count(kind: str):
    return F.size(F.filter("found", lambda x: x["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")


def _spans(found, kind: str):
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x[kind], x["start"], x["end"])), ",")


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir), neardup.SketchParams(shingle=2, threshold=80))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        (quality.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_repeated_lines(_documents(spark, sf_dir), LINE_WORDS)
    return out.select("doc_id", "n_lines", "n_deleted", "deleted_lines", "text")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"),
        F.array_join(
            F.transform("found", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"], x["saved"], x["differ"])), ","
        ).alias("spans"),
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_documents(spark, sf_dir), TARGETS).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 9).alias("probability"), "kept"
    )


def op8_exactdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_documents(spark, sf_dir), keep="max")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spread(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_documents(spark, sf_dir))
    base = F.filter("found", lambda x: x["kind"] != F.lit("guess"))
    counts = [_count(k) for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(_spans(base, "kind"), 256).alias("base_sha256"), _spans(F.col("found"), "kind").alias("spans"),
        F.array_join(F.transform("found", lambda x: F.format_number(x["cost"], 2)), ",").alias("costs"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_documents(spark, sf_dir))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(_documents(spark, sf_dir))


def op13_crosstoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.alignment_rows(_documents(spark, sf_dir))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_pii, op2_neardup, op3_quality, op4_decontaminate, op5_linededup,
            op6_licenses, op7_mix, op8_exactdedup, op9_html, op10_secrets,
            op11_divergence, op12_simhash, op13_crosstoken,
        )
    }


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

OP4_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM bw WHERE len(w) > 0)),
pat AS (SELECT DISTINCT m, p FROM win),
dwin AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM dw CROSS JOIN (SELECT DISTINCT m FROM pat) WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, m, i, p FROM dwin JOIN pat USING (m, p)),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS j FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, list(DISTINCT CAST(item_id AS VARCHAR)) AS items FROM hit JOIN win USING (m, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(list_sort(items), ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
    1 + (1000000000 * CAST(coalesce(c.c, 0) + 2 AS HUGEINT)) // (coalesce(n.n, 0) + 2 * v.v) AS p
  FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term),
q AS (
  SELECT lc.lang, lc.term, 1 + (1000000000 * CAST(lc.c + 2 AS HUGEINT)) // (sum(lc.c) OVER (PARTITION BY lc.lang) + 2 * v.v) AS q
  FROM lc JOIN v ON v.lang = lc.lang),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source),
terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
rows AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term' AS part, * FROM terms)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
"""

OP5_SQL = rf"""
WITH l0 AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL),
l1 AS (SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l0),
l2 AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l1 WHERE w > 0),
l3 AS (SELECT *, upto - w AS before FROM l2),
fw AS (
  SELECT a.doc_id, min(b.pos) AS s, max(b.pos) AS e, sum(b.w) AS ws, string_agg(b.line, chr(10) ORDER BY b.pos) AS c
  FROM l3 a JOIN l3 b ON a.doc_id = b.doc_id AND b.before >= a.before AND b.before < a.before + {LINE_WORDS} GROUP BY a.doc_id, a.pos),
bk AS (
  SELECT a.doc_id, min(b.pos) AS s, max(b.pos) AS e, sum(b.w) AS ws, string_agg(b.line, chr(10) ORDER BY b.pos) AS c
  FROM l3 a JOIN l3 b ON a.doc_id = b.doc_id AND b.upto <= a.upto AND b.upto > a.upto - {LINE_WORDS} GROUP BY a.doc_id, a.pos),
win AS (SELECT DISTINCT doc_id, s, e, c FROM (SELECT * FROM fw UNION ALL SELECT * FROM bk) WHERE ws >= {LINE_WORDS}),
rep AS (SELECT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS pos FROM rep),
agg AS (
  SELECT l0.doc_id, count(*) AS n_lines, count(gone.pos) AS n_deleted,
         coalesce(string_agg(CAST(gone.pos AS VARCHAR), ',' ORDER BY l0.pos) FILTER (WHERE gone.pos IS NOT NULL), '') AS deleted_lines,
         coalesce(string_agg(line, chr(10) ORDER BY l0.pos) FILTER (WHERE gone.pos IS NULL), '') AS text
  FROM l0 LEFT JOIN gone ON l0.doc_id = gone.doc_id AND l0.pos = gone.pos GROUP BY l0.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
       coalesce(deleted_lines, '') AS deleted_lines, agg.text AS text
FROM documents d LEFT JOIN agg ON d.doc_id = agg.doc_id
"""

OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(2, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(2, len(w)) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, edge.y FROM reach JOIN edge ON reach.r = edge.x),
comp AS (SELECT d, min(r) AS c FROM reach GROUP BY d)
SELECT documents.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, comp.c AS component_id, documents.doc_id = comp.c AS kept
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN comp ON comp.d = documents.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_neardup": OP2_SQL,
        "op4_decontaminate": OP4_SQL,
        "op5_linededup": OP5_SQL,
        "op7_mix": mixing_sql(),
        "op8_exactdedup": OP8_SQL,
        "op11_divergence": OP11_SQL,
    }


def mixing_sql(t: mixing.MixTargets = TARGETS) -> str:
    """The mix in SQL: one pair of table expressions per raking step."""

    def named(col: str, targets: dict[str, float]) -> str:
        names = ", ".join(f"'{k}'" for k in targets if k != mixing.REST)
        return f"CASE WHEN {col} IN ({names}) THEN {col} ELSE '*' END"

    def share(dim: str, targets: dict[str, float]) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {v / sum(targets.values())!r}" for k, v in targets.items())
        return f"CAST(CASE {dim} {cases} ELSE 0 END AS DOUBLE)"

    def hits(words: str) -> str:
        return f"len(list_intersect(ws, [{', '.join(repr(w) for w in words.split())}]))"

    most = f"greatest({', '.join(map(hits, mixing.TOPIC_WORDS.values()))})"
    cases = " ".join(f"WHEN {hits(words)} = {most} THEN '{name}'" for name, words in mixing.TOPIC_WORDS.items())
    topic = f"CASE WHEN {most} = 0 THEN '{mixing.GENERAL}' {cases} END"
    parts = [
        f"""d AS (SELECT *, regexp_extract_all({_LOWERED}, '[a-z]+') AS ws FROM documents),
            f AS (SELECT doc_id, source, lang, {topic} AS topic,
              len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM d)""",
        f"""r AS (SELECT doc_id, {named('source', t.source)} AS source, {named('lang', t.lang)} AS lang,
              {named('topic', t.topic)} AS topic, n_tokens FROM f)""",
        "c0 AS (SELECT source, lang, topic, sum(n_tokens) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS w FROM r GROUP BY ALL)",
    ]
    k = 0
    for _ in range(t.rounds):
        for dim in ("source", "lang", "topic"):
            parts.append(
                f"c{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN h > 0 THEN w * {share(dim, getattr(t, dim))} / h ELSE 0 END AS w"
                f" FROM (SELECT *, sum(w) OVER (PARTITION BY {dim}) AS h FROM c{k}))"
            )
            k += 1
    parts.append(f"p AS (SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS p FROM c{k})")
    parts.append(
        f"""s AS (SELECT {t.keep!r} * sum(tokens) FILTER (WHERE p > 0) AS k, sum(tokens * p) AS r0 FROM p),
        z AS (SELECT a.p, max(s.k) AS k, sum(b.tokens) FILTER (WHERE b.p >= a.p) AS held,
                     sum(b.tokens * b.p) FILTER (WHERE b.p < a.p) AS r FROM p a, p b, s WHERE a.p > 0 GROUP BY a.p),
        c AS (SELECT greatest((SELECT k / r0 FROM s), coalesce((SELECT max((k - held) / r) FROM z WHERE r > 0), 0)) AS c),
        q AS (SELECT source, lang, topic, least(1, c * p) AS probability FROM p, c)"""
    )
    return f"""WITH {', '.join(parts)}
    SELECT doc_id, r.source, r.lang, r.topic, n_tokens, round(probability, 9) AS probability,
      CAST(CAST('0x' || substr(md5('{t.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
        / 4503599627370496.0 < probability AS kept
    FROM r JOIN q USING (source, lang, topic)"""
