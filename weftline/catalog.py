"""Registered queries of the passage-matching operators, and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.functions import tokens as K
from weftline.functions import vectors as V
from weftline.functions.profiles import LATIN, ScriptProfile
from weftline.functions.translit import ewts
from weftline.operators import align, embed, enrich, profile, segment, simjoin
from weftline.plans import pipeline
from weftline.plans.config import EmbedConfig, PipelineConfig, SegmentConfig
from weftline.plans.runtime import materialize, read_table, spread
from weftline.sources import readers

# --- Similarity join ---------------------------------------------------------------------

#: Segments of one corpus file in the vector table.
PER_FILE = 10
THRESHOLD = 0.30


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("segment_id"),
        F.floor(F.col("vec_id") / PER_FILE).cast("long").alias("source_file_id"),
        F.col("label").alias("file_id"),
        "embedding",
    )


def _similar(config: simjoin.JoinConfig):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return simjoin.similar_segments(_vectors(spark, sf_dir), config).withColumn("similarity", F.round("similarity", 6))

    return query


def _similar_sql(c: simjoin.JoinConfig) -> str:
    """``batch`` of a file is its rank over the batch size."""
    batch = "0" if c.batch_size is None else f"ord // {c.batch_size}"
    least = f"AND sim >= {c.threshold}" if c.strategy == "threshold" else ""
    return f"""
WITH s AS (SELECT vec_id AS id, vec_id // {PER_FILE} AS file, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT *, dense_rank() OVER (ORDER BY file) - 1 AS ord, sqrt(list_dot_product(v, v)) AS n FROM s),
r AS (SELECT *, {batch} AS batch FROM u),
p AS (SELECT a.id AS a, b.id AS b, list_dot_product(a.v, b.v) / (a.n * b.n) AS sim, a.label AS la, b.label AS lb,
             a.file AS fa, b.file AS fb, b.batch AS batch
      FROM r a JOIN r b ON (a.batch = b.batch AND a.ord < b.ord) OR a.batch > b.batch),
k AS (SELECT *, row_number() OVER (PARTITION BY a, batch ORDER BY sim DESC, b) AS rank FROM p WHERE true {least})
SELECT a AS segment_a_id, b AS segment_b_id, round(sim, 6) AS similarity, la AS file_id_a, lb AS file_id_b,
       fa AS source_file_id_a, fb AS source_file_id_b
FROM k WHERE rank <= {c.most} AND la <> lb"""


JOINS = {
    "sim_threshold_join": simjoin.JoinConfig(threshold=THRESHOLD),
    "sim_threshold_top3": simjoin.JoinConfig(threshold=THRESHOLD, k=3),
    "sim_knn_join": simjoin.JoinConfig(strategy="knn", k=10),
    "sim_batch_scope": simjoin.JoinConfig(threshold=THRESHOLD, k=3, batch_size=7),
}


def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = V.l2_normalize(F.col("embedding"))
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(V.norm(unit), 6).alias("norm"), F.round(F.element_at(unit, 1), 6).alias("first_value")
    )


def cosine_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosines between the mean vectors of the labels, with alerts."""
    rows = read_table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = rows.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    means = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("v"))
    return embed.similarity_alerts(means, "label", "v").withColumn("similarity", F.round("similarity", 6))


def mean_pooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of each vector pooled as two token vectors, the first of which counts double."""
    e = F.col("embedding")
    pooled = V.mean_pool(F.array(F.slice(e, 1, 32), F.slice(e, 33, 32)), F.array(F.lit(2.0), F.lit(1.0)))
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(pooled).cast("long").alias("n"), F.round(F.element_at(pooled, 1), 6).alias("first_value"), F.round(V.norm(pooled), 6).alias("norm")
    )


# --- Text functions ----------------------------------------------------------------------


def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", T.sanitize_text(F.col("text")).alias("text"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.clean_foreign(F.col("text"), LATIN).alias("text"))


def normalize_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", T.normalize_spaces(F.col("html")).alias("text"))


def sanitize_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", T.sanitize_filename(F.col("url")).alias("name"))


def word_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return read_table(spark, sf_dir, "documents").select(
        "doc_id",
        T.syllable_count(text, LATIN).cast("long").alias("n_separators"),
        T.last_word(text, LATIN).alias("last_word"),
        T.last_syllable(text, LATIN).alias("last_syllable"),
    )


def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = T.split_parts(F.col("text"), LATIN)
    return read_table(spark, sf_dir, "documents").select("doc_id", F.posexplode(parts).alias("pos", "part"))


def transliterated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = T.transliterated_tokens(F.col("url"))
    return read_table(spark, sf_dir, "pages").select("page_id", F.posexplode(tokens).alias("pos", "token"))


def transliterate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin text passes through transliteration unchanged."""
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", ewts(F.col("text"), " ").alias("text"))


def input_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return profile.input_profile(docs, F.col("text"), {"lang": F.col("lang"), "source": F.col("source")}, LATIN)


# --- Rules and scripts on the given tables -------------------------------------------------
# The tables are Latin.  A Latin profile with weak boundaries takes the rules through every
# document, and letters written as syllables take whole tables through transliteration.

#: Full stops are strong, commas are boundaries by the words around them.
CLAUSES = ScriptProfile(
    name="clauses", delimiters=".,", separator=" ", script="a-zA-Z", foreign=r"ༀ-࿿", strong_chars=".", digits="0-9",
    terminators=frozenset("re that is".split()), blocking=frozenset("and or the of".split()), sentence_initial=frozenset("with for to".split()),
)
#: A letter of the alphabet, the syllable that stands for it, and its transliteration (fixed values).
LETTERS = tuple(zip(
    "abcdefghijklmnopqrstuvwxyz", "ཀཁགངཅཆཇཉཏཐདནཔཕབམཙཚཛཝཞཟཡརལས",
    "ka kha ga nga ca cha ja nya ta tha da na pa pha ba ma tsa tsha dza wa zha za ya ra la sa".split(), strict=True,
))


def clause_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by rules with strong and weak boundaries."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.exploded(docs.withColumn("atoms", segment.segment_atoms(F.col("text"), CLAUSES)), ["doc_id"])


def syllable_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with their letters as syllables, spaced out: the script without spaces and its transliteration."""
    letters = F.regexp_replace(F.lower("text"), "[^a-z.]", "")
    syllables = F.regexp_replace(F.translate(letters, "".join(x[0] for x in LETTERS) + ".", "".join(x[1] for x in LETTERS) + "།"), "([^།])", "$1་ ")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", syllables.alias("spaced"))
    closed = T.remove_script_spaces(F.col("spaced"))
    return rows.select("conv_id", "turn", closed.alias("closed"), ewts(closed).alias("ewts"))


# --- Segmentation ------------------------------------------------------------------------


def _atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.withColumn("atoms", segment.delimiter_atoms(F.col("text"), LATIN))


def rule_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.exploded(docs.withColumn("atoms", segment.segment_atoms(F.col("text"), LATIN)), ["doc_id"])


def delimiter_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.exploded(_atoms(spark, sf_dir), ["doc_id"])


def token_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.exploded(docs.withColumn("atoms", segment.segment_atoms(F.col("text"), LATIN, "tokens", 4)), ["doc_id"])


def legacy_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.exploded(docs.withColumn("atoms", segment.segment_atoms(F.col("text"), LATIN, "legacy", 4)), ["doc_id"])


def syllable_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _atoms(spark, sf_dir).withColumnRenamed("atoms", "raw")
    return segment.exploded(rows.withColumn("atoms", segment.limit_syllables(F.col("raw"), 2, 12, LATIN)), ["doc_id"])


def word_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.exploded(docs.withColumn("atoms", segment.segment_words(F.col("text"), LATIN, 3, 12)), ["doc_id"])


SPANS = {"max_atoms": 4, "min_chars": 10, "max_chars": 2000, "max_spans": 300}


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.overlapping_spans(_atoms(spark, sf_dir), ["doc_id"], **SPANS)


def segments_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.segments_per_line(delimiter_segments(spark, sf_dir), "doc_id")


# --- Pairs and labels --------------------------------------------------------------------


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring turns of a conversation as pairs of texts."""
    turns = spread(read_table(spark, sf_dir, "conversations"))
    a = turns.select("conv_id", F.col("turn").alias("turn_a"), F.col("text").alias("parallel_a"))
    b = turns.select(F.col("conv_id").alias("c"), (F.col("turn") - 1).alias("t"), F.col("text").alias("parallel_b"))
    return a.join(b, (a.conv_id == b.c) & (a.turn_a == b.t)).drop("c", "t")


def syllable_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.SyllableDistance().transform(_turn_pairs(spark, sf_dir)).select("conv_id", "turn_a", "wylie_syllable_distance")


def token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = lambda c: K.content_tokens(T.transliterated_tokens(F.col(c)))
    pairs = _turn_pairs(spark, sf_dir).select("conv_id", "turn_a", tokens("parallel_a").alias("a"), tokens("parallel_b").alias("b"))
    return pairs.select(
        "conv_id", "turn_a", F.size("a").cast("long").alias("n_a"), F.size("b").cast("long").alias("n_b"),
        F.round(K.jaccard(F.col("a"), F.col("b")), 6).alias("unigram"),
        F.round(K.jaccard(K.bigrams(F.col("a")), K.bigrams(F.col("b"))), 6).alias("bigram"),
    )


def mapping_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = enrich.make_enrichers([{"name": "wylie_levenshtein"}, {"name": "mapping_type"}])
    return enrich.enrich(_turn_pairs(spark, sf_dir), chain).select("conv_id", "turn_a", "wylie_syllable_distance", "mapping_type")


def lexical_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities of matches looked up again by segment id."""
    rows = _vectors(spark, sf_dir)
    matches = simjoin.similar_segments(rows, JOINS["sim_threshold_top3"])
    lexical = rows.select("segment_id", F.col("embedding").alias("emb_lexical"))
    return enrich.LexicalSimilarity(lexical).transform(matches).select("segment_a_id", "segment_b_id", "sim_lexical")


def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages: segments, vectors, matches, labels."""
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("line_number"), "text", F.concat(F.lit("doc"), F.col("doc_id")).alias("file_id")
    )
    config = PipelineConfig(
        segment=SegmentConfig(profile="latin", clean_foreign=False, remove_spaces=False, min_syllables=2, max_syllables=40),
        embed=EmbedConfig(dual_layer=True, transliterate=False),
        detect=simjoin.JoinConfig(threshold=0.6),
    )
    return pipeline.run(docs, config)


# --- Alignment ---------------------------------------------------------------------------

#: As in the reference's shipped configuration.
SEEDING = align.Seeding(k=15, max_gap=10, extend=300, max_kmer_hits=3)
SCORING = align.Scoring(min_score=15.0)


def _dense(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    key = {"documents": "doc_id", "benchmark": "item_id"}[table]
    return align.densify(spread(read_table(spark, sf_dir, table).select(key, "text")), key, "text", SEEDING)


def dense_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense(spark, sf_dir, "documents").select("name", "dense", F.size("coords").cast("long").alias("n"))


def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-mers of each document: positions, distinct k-mers and positions left after pruning."""
    return align.kmer_profile(_dense(spark, sf_dir, "documents"), SEEDING.k, SEEDING.max_kmer_hits)


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.seeds_between(_dense(spark, sf_dir, "benchmark"), _dense(spark, sf_dir, "documents"), SEEDING)


def seed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds between benchmark items and documents."""
    return _seeds(spark, sf_dir)


def seed_pairs_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds between all pairs of benchmark items, with shorter k-mers."""
    return align.seed_pairs(align.kmer_positions(_dense(spark, sf_dir, "benchmark"), 8, SEEDING.max_kmer_hits))


def seed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.seed_regions(_seeds(spark, sf_dir), SEEDING)


def largest_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.largest_regions(seed_regions(spark, sf_dir))


def local_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of benchmark items with documents, overlaps suppressed."""
    return align.seed_and_extend(_dense(spark, sf_dir, "benchmark"), _dense(spark, sf_dir, "documents"), SEEDING, SCORING)


def waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of benchmark items with documents without seeds."""
    items = materialize(_dense(spark, sf_dir, "benchmark"), "dense")
    return align.waterfall(items, _dense(spark, sf_dir, "documents"), align.Scoring(match=1.0, mismatch=-0.9, open=-0.6, extend=-3.5, min_score=12.0))


def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.review_rows(local_align(spark, sf_dir))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records for a JSON-lines file."""
    texts = read_table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id"), F.lit(".txt")).alias("name"), "text")
    return readers.texts_as_documents(texts)


# --- Registration ------------------------------------------------------------------------


def queries() -> dict:
    found = {name: _similar(config) for name, config in JOINS.items()}
    for f in (
        l2_normalize, cosine_matrix, mean_pooling, sanitize_text, clean_text, normalize_spaces, sanitize_filename, word_features,
        split_parts, transliterated_tokens, transliterate, input_profile, rule_segments, delimiter_segments, token_segments,
        legacy_segments, syllable_segments, word_segments, overlapping_spans, segments_per_document, syllable_distance,
        clause_segments, syllable_texts, token_overlap, mapping_type, lexical_similarity, full_pipeline, dense_text, kmer_counts, seed_pairs, seed_pairs_within,
        seed_regions, largest_regions, local_align, waterfall, review_rows, document_records,
    ):
        found[f.__name__] = f
    return found


_PY_SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{_PY_SPACE}]+|[{_PY_SPACE}]+$', '', 'g')"


_SEGMENTS_SQL = rf"""
p AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?]*[.!?]+|[^.!?]+')) AS piece,
             generate_subscripts(regexp_extract_all(text, '[^.!?]*[.!?]+|[^.!?]+'), 1) AS k FROM documents),
q AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS e FROM p),
seg AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS segment_order, {_strip_sql('piece')} AS text,
               CAST(e - length(piece) AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM q
        WHERE NOT (regexp_matches(piece, '[\x{{0F00}}-\x{{0FFF}}]') AND NOT regexp_matches(piece, '[a-zA-Z]')))"""
_DENSE = r"regexp_replace(regexp_replace(text, '\[\\\[[^\]]*\\\]\]|@##|@#|/_|/|\{[^}]*\}', '', 'g'), '[ \n]', '', 'g')"
_PARTICLE_LIST = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in K.EWTS_PARTICLES.split()) + "]"


def oracle_sql() -> dict[str, str]:
    kmers = lambda table, key, k: f"""(SELECT {key} AS name, unnest(generate_series(0, length(d) - {k})) AS pos, d
        FROM (SELECT {key}, {_DENSE} AS d FROM {table}) WHERE length(d) >= {k})"""  # noqa: E731
    pruned = lambda table, key, k: f"""(SELECT name, kmer, pos FROM (SELECT name, kmer, pos, count(*) OVER (PARTITION BY name, kmer) AS c
        FROM (SELECT name, substr(d, CAST(pos + 1 AS BIGINT), {k}) AS kmer, pos FROM {kmers(table, key, k)})) WHERE c <= {SEEDING.max_kmer_hits})"""  # noqa: E731
    every = lambda x: f"list_filter(regexp_split_to_array({x}, '[/{_PY_SPACE}]+'), lambda t: t <> '')"
    share = lambda x, y: f"""(CASE WHEN len(list_distinct(list_concat({x}, {y}))) = 0 THEN 0
        ELSE len(list_intersect(list_distinct({x}), list_distinct({y}))) / len(list_distinct(list_concat({x}, {y}))) END)"""  # noqa: E731
    r = enrich.MappingRules()
    tokens = lambda x: f"list_filter(regexp_split_to_array({x}, '[/{_PY_SPACE}]+'), lambda t: t <> '' AND NOT list_contains({_PARTICLE_LIST}, t))"
    segments = f"WITH {_SEGMENTS_SQL} SELECT doc_id, segment_order, text, start, \"end\", length(text) AS n_chars FROM seg"
    out = {name: _similar_sql(config) for name, config in JOINS.items()}
    out |= {
        "l2_normalize": """SELECT vec_id, round(sqrt(list_dot_product(u, u)), 6) AS norm, round(u[1], 6) AS first_value FROM (
            SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u
            FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))""",
        "cosine_matrix": """WITH e AS (SELECT label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
            m AS (SELECT label, i, avg(x) AS m FROM e GROUP BY label, i),
            v AS (SELECT label, list(m ORDER BY i) AS v FROM m GROUP BY label),
            s AS (SELECT a.label AS id_a, b.label AS id_b,
                  list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-9) AS s
                  FROM v a JOIN v b ON a.label < b.label)
            SELECT id_a, id_b, round(s, 6) AS similarity, CASE WHEN s > 0.9 THEN 'collapsed' WHEN s > 0.8 THEN 'close' ELSE 'distinct' END AS alert FROM s""",
        "mean_pooling": """WITH p AS (SELECT vec_id, list_transform(generate_series(1, 32),
              lambda i: (2 * CAST(embedding[i] AS DOUBLE) + CAST(embedding[i + 32] AS DOUBLE)) / 3) AS p FROM embeddings)
            SELECT vec_id, len(p) AS n, round(p[1], 6) AS first_value, round(sqrt(list_dot_product(p, p)), 6) AS norm FROM p""",
        "sanitize_text": r"SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS text FROM documents",
        "clean_text": f"""SELECT doc_id, {_strip_sql(f"regexp_replace(regexp_replace(text, '[^a-zA-Z{_PY_SPACE}]', '', 'g'), '[{_PY_SPACE}]+', ' ', 'g')")} AS text
            FROM documents""",
        "sanitize_filename": f"""SELECT page_id, {_strip_sql("regexp_replace(regexp_replace(url, '([^/.])[.][^./]*$', chr(92) || '1'), '[<>:\"/' || chr(92) || chr(92) || '|?*]', '_', 'g')")} AS name FROM pages""",
        "word_features": f"""SELECT doc_id, length(text) - length(replace(text, ' ', '')) AS n_separators,
            regexp_extract(regexp_replace(text, '[.!?{_PY_SPACE}]+$', ''), '[^ ]*$') AS last_word,
            regexp_extract(regexp_replace(text, '[{_PY_SPACE}]+$', ''), '[^ ]*$') AS last_syllable FROM documents""",
        "split_parts": """SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS part
            FROM (SELECT doc_id, regexp_extract_all(text, '[.!?]+|[^.!?]+') AS p FROM documents)""",
        "transliterated_tokens": f"""SELECT page_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS token
            FROM (SELECT page_id, list_filter(regexp_split_to_array(url, '[/{_PY_SPACE}]+'), lambda t: t <> '') AS p FROM pages)""",
        "transliterate": "SELECT conv_id, turn, ' ' || text AS text FROM conversations",
        "input_profile": f"""SELECT count(*) AS total, count(*) FILTER (WHERE b = '') AS empty_text,
            count(*) FILTER (WHERE b <> '' AND NOT contains(b, '.')) AS no_delimiter,
            count(*) FILTER (WHERE b <> '' AND NOT contains(b, '.') AND length(b) > {profile.LONG}) AS long_no_delimiter,
            count(*) FILTER (WHERE coalesce(trim(lang), '') = '') AS missing_lang, count(*) FILTER (WHERE coalesce(trim(source), '') = '') AS missing_source
            FROM (SELECT {_strip_sql("coalesce(text, '')")} AS b, lang, source FROM documents)""",
        "rule_segments": segments,
        "delimiter_segments": segments,
        "segments_per_document": f"WITH {_SEGMENTS_SQL} SELECT doc_id, count(*) AS num_segments FROM seg GROUP BY doc_id",
        "overlapping_spans": _spans_sql(),
        "token_overlap": f"""WITH t AS (SELECT a.conv_id, a.turn AS turn_a, {tokens('a.text')} AS a, {tokens('b.text')} AS b
              FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
            g AS (SELECT *, list_transform(generate_series(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1]) AS ga,
                  list_transform(generate_series(1, len(b) - 1), lambda i: b[i] || ' ' || b[i + 1]) AS gb FROM t)
            SELECT conv_id, turn_a, len(a) AS n_a, len(b) AS n_b,
              round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0 ELSE len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(list_concat(a, b))) END, 6) AS unigram,
              round(CASE WHEN len(list_distinct(list_concat(ga, gb))) = 0 THEN 0 ELSE len(list_intersect(list_distinct(ga), list_distinct(gb))) / len(list_distinct(list_concat(ga, gb))) END, 6) AS bigram
            FROM g""",
        "lexical_similarity": f"""WITH m AS ({_similar_sql(JOINS['sim_threshold_top3'])}),
            v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
            SELECT segment_a_id, segment_b_id,
              round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-9), 4) AS sim_lexical
            FROM m JOIN v a ON a.vec_id = segment_a_id JOIN v b ON b.vec_id = segment_b_id""",
        "dense_text": f"SELECT name, dense, length(dense) AS n FROM (SELECT doc_id AS name, {_DENSE} AS dense FROM documents)",
        "kmer_counts": f"""WITH k AS (SELECT name, substr(d, CAST(pos + 1 AS BIGINT), {SEEDING.k}) AS kmer, count(*) AS c
              FROM {kmers('documents', 'doc_id', SEEDING.k)} GROUP BY ALL)
            SELECT name, sum(c) AS n_positions, count(*) AS n_kmers, sum(CASE WHEN c <= {SEEDING.max_kmer_hits} THEN c ELSE 0 END) AS n_kept FROM k GROUP BY name""",
        "seed_pairs": f"""SELECT a.name AS file_a, b.name AS file_b, a.pos AS pos_a, b.pos AS pos_b
            FROM {pruned('benchmark', 'item_id', SEEDING.k)} a JOIN {pruned('documents', 'doc_id', SEEDING.k)} b ON a.kmer = b.kmer""",
        "seed_pairs_within": f"""SELECT a.name AS file_a, b.name AS file_b, a.pos AS pos_a, b.pos AS pos_b
            FROM {pruned('benchmark', 'item_id', 8)} a JOIN {pruned('benchmark', 'item_id', 8)} b ON a.kmer = b.kmer AND a.name < b.name""",
        "normalize_spaces": f"SELECT page_id, {_spaces_sql('html')} AS text FROM pages",
        "clause_segments": _clauses_sql(CLAUSES),
        "syllable_texts": _syllable_texts_sql(),
        "syllable_distance": f"WITH RECURSIVE {_distance_sql(every)} SELECT conv_id, turn_a, d AS wylie_syllable_distance FROM dist",
        "mapping_type": f"""WITH RECURSIVE {_distance_sql(every)},
            k AS (SELECT a.conv_id, a.turn AS turn_a, {tokens("coalesce(a.text, '')")} AS a, {tokens("coalesce(b.text, '')")} AS b
                  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
            g AS (SELECT *, list_transform(generate_series(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1]) AS ga,
                  list_transform(generate_series(1, len(b) - 1), lambda i: b[i] || ' ' || b[i + 1]) AS gb FROM k),
            m AS (SELECT conv_id, turn_a, d, d / greatest(n_a, n_b, 1) AS rel, {share('a', 'b')} AS uni, {share('ga', 'gb')} AS bi
                  FROM g JOIN dist USING (conv_id, turn_a)),
            l AS (SELECT *, uni >= {r.overlap_textual} OR rel <= {r.distance_textual} OR bi >= {r.bigram_textual} AS alike,
                  uni <= {r.overlap_semantic} AND rel >= {r.distance_semantic} AND bi <= {r.bigram_semantic} AS apart FROM m)
            SELECT conv_id, turn_a, d AS wylie_syllable_distance,
              CASE WHEN alike AND NOT apart THEN 'textual' WHEN apart AND NOT alike THEN 'semantic' ELSE 'uncertain' END AS mapping_type FROM l""",
        "document_records": "SELECT text, CAST(doc_id AS VARCHAR) AS file_id FROM documents",
        "syllable_segments": _syllables_sql(2, 12),
        "word_segments": _words_sql(3, 12),
        "token_segments": _folded_sql(legacy=False, least=4),
        "legacy_segments": _folded_sql(legacy=True, least=4),
    }
    regions = _regions_sql(out["seed_pairs"])
    out["seed_regions"] = f"WITH RECURSIVE {regions} SELECT * FROM regions"
    out["largest_regions"] = f"""WITH RECURSIVE {regions}
        SELECT *, CAST(end_a - start_a AS BIGINT) * (end_b - start_b) AS cells FROM regions ORDER BY cells DESC, file_a, file_b, region LIMIT 5"""
    return out


_EXPLODED = 'row_number() OVER (PARTITION BY doc_id ORDER BY part, b) AS segment_order, text, start, "end", length(text) AS n_chars'


def _syllables_sql(low: int, high: int) -> str:
    """Segments of part least ``low`` spaces; long ones are cut before the spaces number high + 1, 2 high + 1 and so on.

    A last piece that is too short isn't cut off.
    """
    return f"""
WITH {_SEGMENTS_SQL},
a AS (SELECT doc_id, segment_order AS part, text, start, "end", length(text) - length(replace(text, ' ', '')) AS n FROM seg),
x AS (SELECT * FROM a WHERE n >= {low}),
s AS (SELECT *, generate_subscripts(string_split(text, ' '), 1) AS k, length(unnest(string_split(text, ' '))) AS size FROM x WHERE n > {high}),
c AS (SELECT *, sum(size) OVER (PARTITION BY doc_id, part ORDER BY k) + k - 1 AS place FROM s),
b AS (SELECT doc_id, part, CAST(0 AS BIGINT) AS b FROM c WHERE k = 1 UNION ALL
      SELECT doc_id, part, CAST(place AS BIGINT) FROM c WHERE k > 1 AND k % {high} = 1 AND k <= n AND NOT (k - 1 = {high} * ((n - 1) // {high}) AND n - k + 1 < {low})),
y AS (SELECT *, lead(b) OVER (PARTITION BY doc_id, part ORDER BY b) AS upto FROM b),
z AS (SELECT doc_id, part, 0 AS b, text, start, "end" FROM x WHERE n <= {high} UNION ALL
      SELECT doc_id, part, b, substr(text, b + 1, coalesce(upto, length(text)) - b), start + b, start + coalesce(upto, length(text)) FROM y JOIN x USING (doc_id, part))
SELECT doc_id, {_EXPLODED} FROM z"""


def _words_sql(low: int, high: int) -> str:
    """Segments of part least ``low`` words; long ones are cut after every ``high``, a short tail stays with the piece before."""
    return f"""
WITH {_SEGMENTS_SQL},
a AS (SELECT doc_id, segment_order AS part, text, start, "end", regexp_extract_all(text, '[{_PY_SPACE}]+|[.!?]+|[^{_PY_SPACE}.!?]+') AS ts FROM seg),
t AS (SELECT doc_id, part, unnest(ts) AS t, generate_subscripts(ts, 1) AS k FROM a),
e AS (SELECT *, CAST(sum(length(t)) OVER (PARTITION BY doc_id, part ORDER BY k) AS BIGINT) AS e FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part ORDER BY k) - 1 AS i, count(*) OVER (PARTITION BY doc_id, part) AS n
      FROM e WHERE NOT regexp_full_match(t, '[{_PY_SPACE}]+')),
g AS (SELECT doc_id, part, n, CASE WHEN n <= {high} THEN 0 WHEN i // {high} = (n - 1) // {high} AND n - {high} * ((n - 1) // {high}) < {low} THEN i // {high} - 1 ELSE i // {high} END AS g,
        min(e - length(t)) AS b, max(e) AS e FROM w WHERE n >= {low} GROUP BY ALL),
z AS (SELECT doc_id, part, b, CASE WHEN n <= {high} THEN text ELSE substr(text, b + 1, e - b) END AS text,
        CASE WHEN n <= {high} THEN start ELSE start + b END AS start, CASE WHEN n <= {high} THEN "end" ELSE start + e END AS "end" FROM g JOIN a USING (doc_id, part))
SELECT doc_id, {_EXPLODED} FROM z"""


def _folded_sql(legacy: bool, least: int) -> str:
    """Segments by the token or the legacy engine: a recursion over a document's delimiters that carries the open segment's start.

    Spaces and letters of both scripts are counted up to each delimiter, so a stretch is judged by differences.
    """
    tokens = "[.!]+|[^.!]+" if legacy else f"[{_PY_SPACE}]+|[.!?]+|[^{_PY_SPACE}.!?]+"
    plain = "NOT mark" if legacy else f"NOT mark AND NOT regexp_full_match(t, '[{_PY_SPACE}]+')"
    last = f"regexp_extract(regexp_replace(word, '[{_PY_SPACE}]+$', ''), '[^ ]*$')" if legacy else "word"
    letters = lambda kind: f"CAST(sum(length(regexp_replace(t, '[^{kind}]', '', 'g'))) OVER w AS BIGINT)"
    tail = "e > b AND NOT (foreign_ > f0 AND latin = l0)" if legacy else f"{_strip_sql('substr(text, b + 1)')} <> ''"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, text, regexp_extract_all(text, '{tokens}') AS ts FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS k FROM d),
m AS (SELECT *, contains(t, '.') OR contains(t, '!') AS mark FROM t),
u AS (SELECT *, CAST(sum(length(t)) OVER w AS BIGINT) AS e, {letters(' ')} AS spaces, {letters(chr(92) + 'x{0F00}-' + chr(92) + 'x{0FFF}')} AS foreign_, {letters('a-zA-Z')} AS latin,
        last_value(CASE WHEN {plain} THEN t END IGNORE NULLS) OVER w AS word
      FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING)),
p AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS r, e, spaces, foreign_, latin, contains(t, '!') AS hard,
        regexp_matches(coalesce({last}, ''), '[0-9]') AS held FROM u WHERE mark),
f AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS s0, CAST(0 AS BIGINT) AS f0, CAST(0 AS BIGINT) AS l0, false AS cut, CAST(0 AS BIGINT) AS before FROM d
  UNION ALL
  SELECT doc_id, r, CASE WHEN cut THEN e ELSE b END, CASE WHEN cut THEN spaces ELSE s0 END, CASE WHEN cut THEN foreign_ ELSE f0 END, CASE WHEN cut THEN latin ELSE l0 END, cut, b
  FROM (SELECT p.*, f.b, f.s0, f.f0, f.l0,
          (hard OR NOT held AND spaces - s0 >= {least}) AND NOT (foreign_ > f0 AND latin = l0) AS cut
        FROM f JOIN p ON p.doc_id = f.doc_id AND p.r = f.r + 1)),
o AS (SELECT doc_id, max_by(b, r) AS b, max_by(f0, r) AS f0, max_by(l0, r) AS l0 FROM f GROUP BY doc_id),
total AS (SELECT doc_id, max(e) AS e, max(foreign_) AS foreign_, max(latin) AS latin FROM u GROUP BY doc_id),
z AS (SELECT doc_id, 0 AS part, before AS b, before AS start, b AS "end" FROM f WHERE cut UNION ALL
      SELECT doc_id, 1, b, b, e FROM o JOIN total USING (doc_id) JOIN d USING (doc_id) WHERE {tail}),
y AS (SELECT doc_id, part, z.b, start, "end", {_strip_sql('substr(text, start + 1, "end" - start)')} AS text FROM z JOIN d USING (doc_id))
SELECT doc_id, {_EXPLODED} FROM y"""


def _clauses_sql(p: ScriptProfile) -> str:
    """Segments by strong and weak boundaries: a recursion over a document's delimiters that carries the open segment's start.

    The word before a delimiter begins after the last space or with the segment.
    """
    listed = lambda words: "(" + ", ".join(f"'{w}'" for w in sorted(words)) + ")"
    opens = " OR ".join(f"starts_with({_strip_sql('coalesce(after, chr(0))')}, '{w}')" for w in sorted(p.section_markers | p.sentence_initial))
    word = "substr(word, greatest(f.b - place, 0) + 1)"
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, text, regexp_extract_all(text, '[.,]+|[{_PY_SPACE}]+|[^{_PY_SPACE}.,]+') AS ts FROM documents WHERE text <> ''),
t AS (SELECT doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS k FROM d),
e AS (SELECT *, CAST(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY k) AS BIGINT) AS e, regexp_full_match(t, '[.,]+') AS mark, regexp_full_match(t, '[{_PY_SPACE}]+') AS space FROM t),
u AS (SELECT *, max(CASE WHEN NOT mark AND NOT space THEN e END) OVER w AS solid, count(CASE WHEN mark THEN 1 END) OVER w AS marks,
        max(CASE WHEN contains(t, ' ') THEN e - length(regexp_extract(t, '[^ ]*$')) END) OVER w AS space_end
      FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING)),
-- The last space before the last character that is neither delimiter nor space.
v AS (SELECT *, coalesce(max(CASE WHEN NOT mark AND NOT space THEN space_end END) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING), 0) AS place FROM u),
n AS (SELECT doc_id, marks, string_agg(t, '' ORDER BY k) AS after FROM u WHERE NOT mark GROUP BY doc_id, marks),
p AS MATERIALIZED (SELECT v.doc_id, v.marks AS r, e, contains(t, '.') AS strong, coalesce(solid, 0) AS solid, place,
        substr(text, CAST(place + 1 AS BIGINT), CAST(greatest(coalesce(solid, 0) - place, 0) AS BIGINT)) AS word, {opens} AS opens
      FROM v JOIN d USING (doc_id) LEFT JOIN n ON n.doc_id = v.doc_id AND n.marks = v.marks WHERE mark),
f AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS b, false AS cut, CAST(0 AS BIGINT) AS before FROM d
  UNION ALL
  SELECT doc_id, r, CASE WHEN cut THEN e ELSE b END, cut, b
  FROM (SELECT p.*, f.b, strong OR solid > f.b AND {word} <> '' AND {word} NOT IN {listed(p.blocking)} AND ({word} IN {listed(p.terminators)} OR opens) AS cut
        FROM f JOIN p ON p.doc_id = f.doc_id AND p.r = f.r + 1)),
o AS (SELECT doc_id, max(b) AS b FROM f GROUP BY doc_id),
z AS (SELECT doc_id, before AS start, b AS "end" FROM f WHERE cut UNION ALL
      SELECT doc_id, b, length(text) FROM o JOIN d USING (doc_id) WHERE b < length(text)),
y AS (SELECT doc_id, 0 AS part, start AS b, start, "end", {_strip_sql('substr(text, start + 1, "end" - start)')} AS text FROM z JOIN d USING (doc_id))
SELECT doc_id, {_EXPLODED} FROM y WHERE NOT (regexp_matches(text, '[\x{{0F00}}-\x{{0FFF}}]') AND NOT regexp_matches(text, '[a-zA-Z]'))"""


def _syllable_texts_sql() -> str:
    letters = "regexp_extract_all(regexp_replace(lower(text), '[^a-z.]', '', 'g'), '.')"
    each = lambda k, end, stop: "CASE c " + " ".join(f"WHEN '{x[0]}' THEN '{x[k]}{end}'" for x in LETTERS) + f" ELSE '{stop}' END"
    joined = lambda k, end, stop: f"array_to_string(list_transform({letters}, lambda c: {each(k, end, stop)}), '')"
    return f"""SELECT conv_id, turn, {joined(1, '་', '།')} AS closed,
        regexp_replace({joined(2, ' ', '/')}, ' $', ' ') AS ewts FROM conversations"""


def _regions_sql(seeds: str) -> str:
    """``regions``: a recursion from the first seed of each region to that of the next, of all pairs at once."""
    k, gap, pad = SEEDING.k, SEEDING.max_gap, SEEDING.extend
    return f"""
q AS ({seeds}),
s AS MATERIALIZED (SELECT file_a, file_b, pos_a AS a, pos_b AS b, pos_a - pos_b AS d, row_number() OVER w AS rn, lag(pos_a) OVER w AS last
      FROM q WINDOW w AS (PARTITION BY file_a, file_b ORDER BY pos_a - pos_b, pos_a)),
h AS (SELECT file_a, file_b, rn, d, a FROM s WHERE rn = 1 UNION ALL
      SELECT h.file_a, h.file_b, min(s.rn), arg_min(s.d, s.rn), arg_min(s.a, s.rn) FROM h JOIN s ON s.file_a = h.file_a AND s.file_b = h.file_b AND s.rn > h.rn
      WHERE s.a - s.last > {gap} OR s.d - h.d > {gap} OR s.a - h.a >= {align.MAX_REGION} GROUP BY h.file_a, h.file_b),
c AS (SELECT s.*, count(h.rn) OVER (PARTITION BY s.file_a, s.file_b ORDER BY s.rn) - 1 AS region FROM s LEFT JOIN h ON h.file_a = s.file_a AND h.file_b = s.file_b AND h.rn = s.rn),
regions AS (SELECT file_a, file_b, region, count(*) AS n_seeds, CAST(greatest(min(a) - {pad}, 0) AS INTEGER) AS start_a, CAST(max(a) + {k + pad} AS INTEGER) AS end_a,
      CAST(greatest(min(b) - {pad}, 0) AS INTEGER) AS start_b, CAST(max(b) + {k + pad} AS INTEGER) AS end_b FROM c GROUP BY file_a, file_b, region)"""


def _spaces_sql(x: str) -> str:
    """Spaces inside Tibetan, before its punctuation, and around ``_`` and ``/``."""
    x = f"regexp_replace({x}, '([\\x{{0F00}}-\\x{{0FFF}}])[{_PY_SPACE}]+([\\x{{0F00}}-\\x{{0FFF}}])', '\\1\\2', 'g')"
    for mark in ("་", "།", "༎", "༔"):
        x = f"regexp_replace({x}, '[{_PY_SPACE}]+{mark}', '{mark}', 'g')"
    x = _strip_sql(f"regexp_replace({x}, '  +', ' ', 'g')")
    for mark in ("_", "/"):
        x = f"regexp_replace({x}, '[{_PY_SPACE}]*{mark}[{_PY_SPACE}]*', '{mark}', 'g')"
    return _strip_sql(f"regexp_replace({x}, '  +', ' ', 'g')")


def _distance_sql(tokens) -> str:
    """``dist``: conv_id, turn_a, n_a, n_b and d, the edit distance of neighbouring turns in tokens, a row of the table at a time.

    A cell is the least over the cells to its left of that cell without insertions plus the way to it.
    """
    return f"""
t AS (SELECT a.conv_id, a.turn AS turn_a, {tokens("coalesce(a.text, '')")} AS a, {tokens("coalesce(b.text, '')")} AS b
      FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
lev AS (SELECT conv_id, turn_a, a, b, CAST(0 AS BIGINT) AS i, CAST(range(0, len(b) + 1) AS BIGINT[]) AS r FROM t
  UNION ALL
  SELECT conv_id, turn_a, a, b, i + 1, list_transform(c, lambda x, j: j - 1 + list_min(list_transform(c[1:j], lambda y, k: y - (k - 1))))
  FROM (SELECT *, list_transform(range(1, len(b) + 2), lambda k: CASE WHEN k = 1 THEN i + 1
          ELSE least(r[k] + 1, r[k - 1] + CASE WHEN a[i + 1] = b[k - 1] THEN 0 ELSE 1 END) END) AS c FROM lev WHERE i < len(a))),
dist AS (SELECT conv_id, turn_a, len(a) AS n_a, len(b) AS n_b, r[len(b) + 1] AS d FROM lev WHERE i = len(a))"""


def _spans_sql() -> str:
    s = SPANS
    return rf"""
WITH {_SEGMENTS_SQL},
n AS (SELECT doc_id, count(*) AS n FROM seg GROUP BY doc_id),
f AS (SELECT s.doc_id, s.segment_order AS i, s.segment_order + w - 1 AS j, 0 AS part, s.segment_order AS r1, w AS r2, 'forward' AS span_type
      FROM seg s JOIN n USING (doc_id) CROSS JOIN generate_series(1, {s['max_atoms']}) AS g(w) WHERE s.segment_order + w - 1 <= n),
c AS (SELECT s.doc_id, greatest(s.segment_order - l + 1, 1) AS i, least(s.segment_order + r, n) AS j, 1 AS part, s.segment_order AS r1, k AS r2, 'centered' AS span_type
      FROM seg s JOIN n USING (doc_id) CROSS JOIN (VALUES (1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 2, 3), (5, 3, 2)) AS p(k, l, r)),
u AS (SELECT * FROM f UNION ALL SELECT * FROM c),
o AS (SELECT u.*, a.start, b."end", j - i + 1 AS n_atoms FROM u JOIN seg a ON a.doc_id = u.doc_id AND a.segment_order = i
      JOIN seg b ON b.doc_id = u.doc_id AND b.segment_order = j),
d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, start, "end" ORDER BY part, r1, r2) AS k FROM o),
t AS (SELECT d.*, substr(documents.text, CAST(d.start + 1 AS BIGINT), CAST(d."end" - d.start AS BIGINT)) AS raw
      FROM d JOIN documents USING (doc_id) WHERE k = 1),
v AS (SELECT *, {_strip_sql('raw')} AS text, row_number() OVER (PARTITION BY doc_id ORDER BY part, r1, r2) AS segment_order FROM t
      WHERE length({_strip_sql('raw')}) >= {s['min_chars']} AND length(raw) <= {s['max_chars']})
SELECT doc_id, segment_order, text, start, "end", n_atoms, span_type FROM v WHERE segment_order <= {s['max_spans']}"""
