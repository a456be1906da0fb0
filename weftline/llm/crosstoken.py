"""Alignment of two tokenizers over the same bytes, with corpus-wide link counts.

Each document is encoded by both tokenizers and a dangling-suffix transducer walks the two
sequences: its state is the side that leads and the bytes by which it leads, each step takes
the next token of the side that is behind, and where nothing dangles a group closes.  The
steps are memoised by state and token, so the walk compares no bytes for tokens that it met
before in the same state.

The tokenizer files are read once on the driver and sent to the executors (a few MB, the size
of two vocabularies), so a path has to exist on the driver alone.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import materialize, small_batches

#: Where the tokenizer files lie unless a parameter says otherwise.
TOKENIZER_DIR = "/opt/tokenizers"
#: Transitions that a Python worker keeps: about 200 MB at most.
TRANSITIONS = 1_000_000
#: Pair counts that a task gathers before it merges them.
GATHERED = 2_000_000
#: Bits of a token id: vocabularies hold fewer than a million tokens.
ID_BITS = 20
_ID = (1 << ID_BITS) - 1
#: Pair counts of at most so many bytes are sent whole to every executor.
COUNT_BYTES = 64 << 20
#: Characters of the texts that are tokenized at a time.
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Tokenizers:
    """The two tokenizers, as the contents of their files: byte-level BPE (A) and pieces (B)."""

    a: str
    b: bytes

    @staticmethod
    def read(directory: str = TOKENIZER_DIR, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> Tokenizers:
        with open(os.path.join(directory, a), encoding="utf-8") as f, open(os.path.join(directory, b), "rb") as g:
            return Tokenizers(f.read(), g.read())


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the code
    points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: U+2581 is a space, ``<0xHH>`` a byte."""
    if m := re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode("utf-8")


class Transducer:
    """Cuts two token sequences of the same bytes where both end.

    State 0 is the empty residual; every other state is a pair (does A lead, unmatched bytes).
    """

    def __init__(self, a: list[bytes], b: list[bytes]) -> None:
        self.a, self.b = a, b
        self._clear()

    def _clear(self) -> None:
        self.residuals: list[tuple[bool, bytes]] = [(False, b"")]
        self.leads = [False]
        self.states = {(False, b""): 0}
        self.next: dict[int, int] = {}
        self.first: dict[int, int] = {}
        self.names: dict[int, str] = {}

    def step(self, state: int, token: int) -> int:
        """The state after the next token of the side behind; -1 where the bytes differ."""
        leads, rest = self.residuals[state]
        more = self.b[token] if leads else self.a[token]
        if rest.startswith(more):
            after = (leads and len(rest) > len(more), rest[len(more) :])
        elif more.startswith(rest):
            after = (not leads, more[len(rest) :])
        else:
            return -1
        if not after[1]:
            return 0
        found = self.states.get(after)
        if found is None:
            found = self.states[after] = len(self.residuals)
            self.residuals.append(after)
            self.leads.append(after[0])
        return found

    def start(self, code: int) -> int:
        """The state after a first token of A and one of B."""
        state = self.step(0, code >> ID_BITS)
        return self.step(state, code & _ID) if state >= 0 else -1

    def groups(self, a: list[int], b: list[int]) -> Alignment | None:
        """The groups of two sequences; None where the bytes differ."""
        if len(self.next) + len(self.first) > TRANSITIONS:
            self._clear()
        codes: list[int] = []
        texts: list[str] = []
        add_code, add_text = codes.append, texts.append
        first, name, steps, leads = self.first.get, self.names.get, self.next.get, self.leads
        rest_a, rest_b = iter(a), iter(b)
        more_a = more_b = 0
        for x, y in zip(rest_a, rest_b):  # A's next token always leads where nothing dangles
            code = x << ID_BITS | y
            text = name(code)
            if text is None:  # the two don't close a group, or weren't met before
                state = first(code)
                if state is None:
                    state = self.first[code] = self.start(code)
                    if state == 0:
                        self.names[code] = f"{x}|{y}"
                xs, ys = [x], [y]
                while state > 0:
                    side, to = (rest_b, ys) if leads[state] else (rest_a, xs)
                    token = next(side, -1)
                    if token < 0:
                        return None
                    to.append(token)
                    key = state << ID_BITS | token
                    after = steps(key)
                    if after is None:
                        after = self.next[key] = self.step(state, token)
                    state = after
                if state < 0:
                    return None
                more_a += len(xs) - 1
                more_b += len(ys) - 1
                code = xs[-1] << ID_BITS | ys[-1]
                text = f"{','.join(map(str, xs))}|{','.join(map(str, ys))}"
            add_code(code)
            add_text(text)
        n = len(codes)
        return Alignment(len(a), len(b), codes, texts) if n + more_a == len(a) and n + more_b == len(b) else None


@dataclass
class Alignment:
    """Groups of two token sequences.

    ``codes`` has the last tokens of each group, the pair whose byte ranges end together, as
    ``a << ID_BITS | b``; no token is empty, so a group makes one link.
    """

    n_a: int
    n_b: int
    codes: list[int]
    texts: list[str]

    def text(self) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        return ";".join(self.texts)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs and how often each is linked."""
        return np.unique(np.array(self.codes, np.int64), return_counts=True)


#: Texts of characters whose classes no version of Unicode or of a pattern library disputes.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: What byte-level BPE works on, one match at a time; no token crosses it (fixed value).
BYTE_LEVEL = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN_PARTS = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\t-\r A-Za-zÀ-ÖØ-öø-ÿ0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
#: Texts on which the two libraries have to agree before the faster one is used.
PROBES = (
    "The licence isn't  valid.\n\n\tIn 1,234 countries: we'll see, they've gone 'so' he'd said...", "Être, où ça? Straße; ÿé 12é3",
    "  lead", "trail  ", " ", "\n", "a  b   c \n d\t\te", "<|endoftext|> <s> </s> <0x41>", "x" * 300, "don''t '' 's ' 'S 'LL", "~!@#$%^&*()_+ {}|:<>? ",
)


class Aligner:
    """Both tokenizers, their tokens' bytes and the transducer of a Python worker."""

    def __init__(self, files: Tokenizers) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encode_a = Tokenizer.from_str(files.a)
        self.encode_a.encode_special_tokens = True  # their strings inside a text are plain text
        self.encode_b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.encode_a.get_vocab(with_added_tokens=True).items()}
        special = {i: t.content for i, t in self.encode_a.get_added_tokens_decoder().items()}
        self.a = [
            special[i].encode() if i in special else bytes(alphabet[c] for c in names.get(i, "")) for i in range(max(names) + 1)
        ]
        self.b = [piece_bytes(self.encode_b.id_to_piece(i)) for i in range(self.encode_b.get_piece_size())]
        self.transducer = Transducer(self.a, self.b)
        self.ranked = self._ranked(files.a)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encode_a.encode_batch_fast(texts, add_special_tokens=False)]

    def _ranked(self, file: str) -> Callable[[str], list[int]] | None:
        """The same byte-level BPE in the library that ranks merges by token id, some five times faster.

        None unless the file says that both agree: plain byte-level BPE whose merges make ids in
        ascending order and whose tokens each encode as themselves, and the probes agree.
        """
        spec = json.loads(file)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        if not plain or not all(t["special"] for t in spec.get("added_tokens", [])):
            return None
        import tiktoken

        special = {t["id"] for t in spec.get("added_tokens", [])}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        ranks = {x: i for i, x in enumerate(self.a) if x and i not in special}
        if made != sorted(made) or len(ranks) != len(made) + 256:
            return None
        texts = {i: x.decode("utf-8", "replace") for i, x in enumerate(self.a) if i not in special}
        one = {i: t for i, t in texts.items() if _PLAIN.fullmatch(t) and _PLAIN_PARTS.findall(t) == [t]}
        if self._whole(list(one.values())) != [[i] for i in one]:
            return None
        encode = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return encode if [encode(p) for p in PROBES] == self._whole(list(PROBES)) else None

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids, of plain texts by ranks where that is possible."""
        rest = [t for t in texts if not self.ranked or not _PLAIN.fullmatch(t)]
        whole = iter(self._whole(rest) if rest else [])
        return [self.ranked(t) if self.ranked and _PLAIN.fullmatch(t) else next(whole) for t in texts]

    def align(self, texts: list[str | None]) -> Iterator[Alignment | None]:
        """One alignment per text, None for texts without tokens."""
        part: list[str | None] = []
        size = 0
        for text in texts:
            part.append(text or None)
            size += len(text or "")
            if size >= CHUNK_BYTES:
                yield from self._align(part)
                part, size = [], 0
        yield from self._align(part)

    def _align(self, texts: list[str | None]) -> Iterator[Alignment | None]:
        some = [t for t in texts if t]
        both = zip(self.ids_a([" " + t for t in some]), self.encode_b.encode(some, num_threads=1) if some else [], strict=True)
        for text in texts:
            if not text:
                yield None
                continue
            a, b = next(both)
            same = b"".join(map(self.a.__getitem__, a)) == b" " + text.encode("utf-8")
            yield self.transducer.groups(a, b) if same else None


@lru_cache(maxsize=1)
def _aligner(files: Tokenizers) -> Aligner:
    return Aligner(files)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts by pair."""
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in parts]))
    return pairs, counts


_DOC = "row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string"
_LINKS = "link_a array<int>, link_b array<int>, times array<int>, task_pairs array<long>, task_times array<long>"


def align_tokens(
    docs: DataFrame, files: Tokenizers | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document with its alignment, and the tasks' pair counts.

    ``groups`` is the alignment as ``a1,a2|b1;a3|b2,b3``, null for texts without tokens; ``link_a``, ``link_b`` and ``times`` are a document's linked id pairs and how often each is
    linked.  Rows whose ``row`` is null hold what a task has counted over its documents, in
    ``task_pairs`` and ``task_times``.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(files or Tokenizers.read())
    small_batches(spark, 256)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"{_DOC.format(id=source.schema['doc_id'].dataType.simpleString())}, {_LINKS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(sent.value)
        row = TaskContext.get().partitionId() << 40
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), aligner.align(batch.column("text").to_pylist()), strict=True):
                row += 1
                if found is None:
                    rows.append((row, doc_id, 0, 0, 0, 0, None, [], [], [], None, None))
                    continue
                pairs, times = found.links()
                parts.append((pairs, times))
                held += len(pairs)
                if held > GATHERED:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > GATHERED // 2:
                        yield _batch([(*[None] * 10, *parts[0])], id_type)
                        parts, held = [], 0
                n = len(found.codes)
                rows.append((row, doc_id, found.n_a, found.n_b, n, n, found.text(), pairs >> ID_BITS, pairs & _ID, times, None, None))
            yield _batch(rows, id_type)
        if parts:
            yield _batch([(*[None] * 10, *_merged(parts))], id_type)

    return source.mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    names = [x.split()[0] for x in f"{_DOC}, {_LINKS}".split(", ")]
    types = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 3, *[pa.list_(pa.int64())] * 2]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([_array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _array(values: tuple, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind) or any(v is None for v in values):
        return pa.array(list(values), kind)
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate([np.asarray(v) for v in values]) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.value_type.to_pandas_dtype())))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): corpus-wide links of each id pair, and whether no pair of its B id has more."""
    counted = aligned.where(F.col("row").isNull()).select(F.explode(F.arrays_zip("task_pairs", "task_times")).alias("x"))
    counts = counted.groupBy(F.col("x.task_pairs").alias("pair")).agg(F.sum("x.task_times").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(_ID)), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row for each id of B at most
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_rows(
    docs: DataFrame,
    files: Tokenizers | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    count_bytes: int = COUNT_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null or empty, and those whose joined tokens differ from space + text in
    either tokenizer, have no tokens: zeros and an empty ``groups_sha256``.  ``n_best`` counts
    links whose id pair has the highest corpus-wide count of its B id, ties included, and
    ``count_sum`` adds up the counts.  Rows that repeat an id or a text count each; null ids
    stay null.  Texts of any length are taken whole.  Other columns are ignored; an empty table
    gives an empty result.

    Pair counts of up to ``count_bytes``, 17 bytes each, are sent to every executor; larger
    tables are joined.
    """
    aligned = align_tokens(docs, files, id_col, text_col)
    digest = F.coalesce(F.sha2("groups", 256), F.lit("")).alias("groups_sha256")
    aligned = materialize(aligned.select(*[digest if c == "groups" else c for c in aligned.columns]), "aligned")
    counts = materialize(pair_counts(aligned), "pair-bests")
    rows = aligned.where(F.col("row").isNotNull())
    looked_up = _from_arrays if 17 * counts.count() <= count_bytes else _from_join
    return looked_up(rows, counts).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _from_arrays(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with n_best and count_sum, from counts of a checked size in every task."""
    table = counts.orderBy("pair").toArrow()
    columns = [table.column(c).to_numpy() for c in ("pair", "count", "best")]
    sent = rows.sparkSession.sparkContext.broadcast(columns)
    kept = rows.drop("row", "task_pairs", "task_times")
    out = kept.drop("link_a", "link_b", "times")
    names = out.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + ", n_best long, count_sum long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = sent.value
        for batch in batches:
            lists = {c: batch.column(c) for c in ("link_a", "link_b", "times")}
            a, b, times = (x.flatten().to_numpy().astype(np.int64) for x in lists.values())
            at = np.searchsorted(pairs, a << ID_BITS | b)
            ends = np.cumsum(lists["times"].value_lengths().to_numpy())
            sums = []
            for x in (times * best[at], times * count[at]):
                upto = np.concatenate([[0], np.cumsum(x)])[ends]
                sums.append(pa.array(np.diff(upto, prepend=0), pa.int64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *sums], names=[*names, "n_best", "count_sum"])

    return kept.mapInArrow(run, schema)


def _from_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join, for counts of any size; a pair's side has one row, so Spark can split hot pairs."""
    links = rows.select("row", F.explode(F.arrays_zip("link_a", "link_b", "times")).alias("x")).select(
        "row", F.shiftleft(F.col("x.link_a").cast("long"), ID_BITS).bitwiseOR(F.col("x.link_b").cast("long")).alias("pair"), "x.times"
    )
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select(*rows.columns, zero("n_best"), zero("count_sum"))
