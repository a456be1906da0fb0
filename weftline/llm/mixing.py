"""Mixing sources to target weights by iterative proportional fitting.

Token counts are aggregated to cells of source x language x topic.  Raking scales the cells
in turn until the source, language and topic marginals meet their targets.  A cell's raked
weight over its tokens, times one factor for all cells, is the probability with which each of
its documents is sampled; the factor is set so that the expected sample has the wanted size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ascii_lower, fresh
from weftline.plans.runtime import materialize

#: Stands for every category that a target doesn't name.
REST = "*"
#: Cells that targets may make: they meet in one row, and their rates go to every executor.
MOST_CELLS = 2000


@dataclass(frozen=True)
class MixTargets:
    """Target shares by category; ``"*"`` takes all categories without a share of their own.

    Shares are relative within a marginal.  A marginal without targets isn't raked.
    """

    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)
    rounds: int = 25
    #: Share of all tokens in cells with weight that the sample is expected to hold.
    keep: float = 0.5
    seed: str = "mix"

    def __post_init__(self) -> None:
        if self.cells() > MOST_CELLS:
            raise ValueError(f"targets make {self.cells()} cells, more than {MOST_CELLS}")

    def cells(self) -> int:
        """The most cells there can be: it depends on the targets alone, not on the data."""
        return (len(self.source) + 1) * (len(self.lang) + 1) * (len(self.topic) + 1)


#: Subject words of each topic, ASCII, in four languages (a parameter of :func:`keyword_topic`).
TOPIC_WORDS: dict[str, str] = {
    "computing": "software server database password token api code program algorithm network browser file http https www html "
    "logiciel serveur fichier rechner datei programm passwort servidor archivo programa contrasena",
    "law": "license licensed licence rights court judge contract copyright statute liability plaintiff lawyer permission "
    "droit tribunal contrat gericht vertrag gesetz recht derecho contrato ley juez",
    "science": "experiment theory molecule energy physics biology chemistry species laboratory hypothesis equation "
    "energie theorie versuch teilchen espece energia teoria experimento especie",
    "health": "patient doctor hospital disease treatment symptom therapy medicine clinical vaccine "
    "malade medecin maladie arzt krankheit krankenhaus medico enfermedad tratamiento",
    "business": "market company price profit bank investor revenue payment invoice account "
    "entreprise marche banque unternehmen preis konto empresa mercado precio banco cuenta",
    "sport": "match player coach goal season championship tournament score league stadium "
    "joueur equipe saison spieler mannschaft trainer jugador equipo temporada partido",
}
GENERAL = "general"


def keyword_topic(df: DataFrame, text: Column, into: str, words: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the topic of a text in column ``into``: that with the most different subject words.

    Words are runs of a-z after A-Z is lower-cased; ties go to the topic named first, a text
    with none is ``general``.  The text is split once.
    """
    table = {k: v.split() for k, v in (TOPIC_WORDS if words is None else words).items()}
    known = F.array(*[F.lit(w) for w in sorted({w for ws in table.values() for w in ws})])
    hits = lambda ws: F.size(F.array_intersect(into, F.array(*[F.lit(w) for w in ws])))
    df = df.withColumn(into, F.array_intersect(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[^a-z]+"), known))
    most = F.array_max(F.array(F.lit(0), *[hits(ws) for ws in table.values()]))
    topic = F.when(F.size(into) == 0, GENERAL)
    for name, ws in table.items():
        topic = topic.when(hits(ws) == most, name)
    return df.withColumn(into, topic)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, the token unit of the mix."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _named(col: Column, targets: dict[str, float]) -> Column:
    names = [k for k in targets if k != REST]
    return F.when(col.isin(names), col).otherwise(F.lit(REST)) if names else F.lit(REST)


def _share(name: str, targets: dict[str, float]) -> str:
    total = sum(targets.values())
    cases = " ".join(f"WHEN '{k.replace(chr(39), chr(39) * 2)}' THEN {float(v) / total!r}D" for k, v in targets.items())
    return f"CASE {name} {cases} ELSE 0D END"


def _rake(cells: str, dim: str, targets: dict[str, float]) -> str:
    """SQL: the array ``cells`` scaled so that the sums over ``dim`` are in target proportion.

    Categories that have a target but no tokens are left out, and so are categories with
    neither a target of their own nor one for the rest: they keep weight 0.
    """
    if not targets:
        return cells
    held = f"aggregate(cs, 0D, (a, y) -> a + IF(y.{dim} = x.{dim}, y.w, 0D))"
    return (
        f"transform(array({cells}), cs -> transform(cs, x -> named_struct('source', x.source, 'lang', x.lang,"
        f" 'topic', x.topic, 'tokens', x.tokens, 'w', IF({held} > 0, x.w * ({_share('x.' + dim, targets)}) / {held}, 0D))))[0]"
    )


def rake_cells(cells: DataFrame, targets: MixTargets) -> DataFrame:
    """Cells (source, lang, topic, tokens) with ``weight``, the raked token share.

    All cells meet in one row; their number is bounded by ``targets.cells()``.
    """
    one = cells.select(
        F.struct("source", "lang", "topic", "tokens", F.col("tokens").cast("double").alias("w")).alias("c")
    ).agg(F.array_sort(F.collect_list("c")).alias("cells"))
    step = "acc"
    for dim in ("source", "lang", "topic"):
        step = _rake(step, dim, getattr(targets, dim))
    raked = one.select(F.expr(f"aggregate(sequence(1, {int(targets.rounds)}), cells, (acc, i) -> {step})").alias("cells"))
    return raked.select(F.explode("cells").alias("c")).select(
        "c.source", "c.lang", "c.topic", "c.tokens", F.col("c.w").alias("weight")
    )


def sampling_rates(cells: DataFrame, targets: MixTargets) -> DataFrame:
    """(source, lang, topic, probability): min(1, c * weight / tokens) by cell.

    Expected tokens are a concave function of c, the minimum over k of the line on which the
    k densest cells are saturated, so c is the largest of those lines' solutions.  Cells that
    ask for more than they have keep all their documents, and fall short of their target.
    """
    per_token = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    one = rake_cells(cells, targets).agg(
        F.collect_list(F.struct("source", "lang", "topic", F.col("tokens").cast("double").alias("t"), per_token.alias("p"))).alias("c")
    )
    total = lambda value, where: f"aggregate(filter(c, y -> {where}), 0D, (a, y) -> a + {value})"
    wanted = f"{float(targets.keep)!r}D * {total('y.t', 'y.p > 0')}"
    line = f"(k - {total('y.t', 'y.p >= x.p')}) / {total('y.t * y.p', 'y.p < x.p')}"
    lines = f"transform(filter(c, x -> x.p > 0 AND {total('y.t * y.p', 'y.p < x.p')} > 0), x -> {line})"
    return (
        one.withColumn("k", F.expr(wanted))
        .withColumn("all", F.expr(total("y.t * y.p", "true")))
        .withColumn("f", F.expr(f"array_max(concat(array(IF(all > 0, k / all, 0D)), {lines}))"))
        .select("f", F.explode("c").alias("x"))
        .select("x.source", "x.lang", "x.topic", F.least(F.lit(1.0), F.col("f") * F.col("x.p")).alias("probability"))
    )


def _tagged(docs: DataFrame, targets: MixTargets, topic: Column | None, names: dict[str, str], own: dict[str, str]) -> DataFrame:
    """``docs`` with the cell and the token count of each row, in the columns that ``own`` names."""
    text = F.col(names.get("text_col", "text"))
    out = docs.withColumn(own["topic"], topic) if topic is not None else keyword_topic(docs, text, own["topic"])
    return out.withColumns({
        own["source"]: _named(F.col(names.get("source_col", "source")), targets.source),
        own["lang"]: _named(F.col(names.get("lang_col", "lang")), targets.lang),
        own["topic"]: _named(F.col(own["topic"]), targets.topic),
        own["n_tokens"]: word_count(text),
    })


DIMENSIONS = ("source", "lang", "topic")


def mix_documents(docs: DataFrame, targets: MixTargets, topic: Column | None = None, **names: str) -> DataFrame:
    """One row per input row: doc_id, source, lang, topic, n_tokens, probability, kept.

    ``topic`` is the subject by keywords where it isn't given.  ``names`` may set id_col,
    text_col, source_col and lang_col.  The draw is a hash of seed and id, the same in every
    run; rows that repeat an id share its draw.  A null source, language or topic falls under
    the rest.  Null and empty texts have no tokens, they are drawn at their cell's rate.  An
    empty table gives an empty result.  Texts are read once: ids, cells and counts are written
    to the shared folder.
    """
    own = {k: fresh(docs, k) for k in (*DIMENSIONS, "n_tokens")}
    rows = _tagged(docs, targets, topic, names, own).select(
        F.col(names.get("id_col", "doc_id")).alias("doc_id"), *[F.col(v).alias(k) for k, v in own.items()]
    )
    rows = materialize(rows, "mix-rows")
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    # At most MOST_CELLS rows, whatever the input.
    out = rows.join(F.broadcast(sampling_rates(cells, targets)), [*DIMENSIONS], "left")
    return out.select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability",
        (uniform(F.col("doc_id"), targets.seed) < F.col("probability")).alias("kept"),
    )


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the MD5 of seed and key: 52 bits, the same on every engine."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample_mix(docs: DataFrame, targets: MixTargets, topic: Column | None = None, **names: str) -> DataFrame:
    """The rows of ``docs`` that the mix keeps, with all their columns and ``mix_probability``."""
    own = {k: fresh(docs, k) for k in (*DIMENSIONS, "n_tokens")}
    tagged = materialize(_tagged(docs, targets, topic, names, own), "mix-documents")
    cells = tagged.groupBy([F.col(own[k]).alias(k) for k in DIMENSIONS]).agg(F.sum(own["n_tokens"]).alias("tokens"))
    rates = sampling_rates(cells, targets).select(
        *[F.col(k).alias(own[k]) for k in DIMENSIONS], F.col("probability").alias("mix_probability")
    )
    return (
        tagged.join(F.broadcast(rates), [own[k] for k in DIMENSIONS])
        .where(uniform(F.col(names.get("id_col", "doc_id")), targets.seed) < F.col("mix_probability"))
        .drop(*own.values())
    )
