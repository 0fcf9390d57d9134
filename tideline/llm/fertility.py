"""Quality rules from tokenizer fertility.

Public vocabularies measure each text: characters per token, the share of tokens that are
bare bytes, and the entropy of its tokens. Clean text of one language keeps to narrow
bands of these; bands are fitted per language (per script where no language is given) on
all documents that pass the base rules, and texts outside them are rejected.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrays import mix
from tideline.llm.common import BROADCAST_BYTES, keyed, slices, small_batches, text_key, text_of, worker_state
from tideline.session import stored

VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
#: Words a worker remembers, at about 300 bytes each; rarer ones are measured anew.
CACHE_WORDS = 350_000
#: Bytes of text handled at once in a worker.
CHUNK = 1 << 20
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\v\f\r"
#: First code point of each script's main block; the script of a text is that of most letters.
SCRIPTS = [
    (0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"),
    (0x600, "arabic"), (0x900, "indic"), (0xE00, "southeast"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x2C00, "other"), (0x3040, "kana"), (0x3400, "han"),
    (0xAC00, "hangul"), (0xD7B0, "other"),
]

METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens array<long>, n_bytes array<long>, entropy double, script string"
)


class Vocabulary:
    """Tokens of single words, and which of them are bare bytes."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda words: model.encode([w.decode() for w in words], num_threads=1)
            self.bare = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        else:
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            pattern = public_tokenizers.PATTERN
            model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda words: [model.encode_ordinary(" " + w.decode()) for w in words]
            self.bare = np.zeros(max(ranks.values()) + 1, bool)
            for token, rank in ranks.items():
                self.bare[rank] = not token.isascii() and token.decode(errors="replace").count("�") > 0


class Measure:
    """Numbers for words, with the tokens of each; a worker keeps one."""

    def __init__(self, paths: Sequence[str]):
        self.vocabularies = [Vocabulary(p) for p in paths]
        self.words: dict[bytes, int] = {}
        self.first: list[np.ndarray] = []
        self.counts = np.zeros((0, 2 * len(paths)), np.int32)

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Codes of the words, per code the token counts, and per code the first vocabulary's tokens."""
        new = [w for w in set(words) if w not in self.words]
        known = self.words
        if new:
            if len(known) >= CACHE_WORDS:
                known = {w: known[w] for w in set(words).difference(new)}
                order = {c: i for i, c in enumerate(known.values())}
                first = [self.first[c] for c in order]
                counts = self.counts[list(order)]
                known = {w: order[c] for w, c in known.items()}
            else:
                first, counts = self.first, self.counts
            start = len(first)
            known.update((w, start + i) for i, w in enumerate(new))
            columns = []
            for k, v in enumerate(self.vocabularies):
                got = v.encode(new)
                sizes = np.fromiter(map(len, got), np.int32, len(got))
                flat = np.fromiter((t for ids in got for t in ids), np.int32, int(sizes.sum()))
                ends = np.cumsum(sizes)
                bare = np.concatenate([[0], np.cumsum(v.bare[flat])])
                columns += [sizes, bare[ends] - bare[ends - sizes]]
                if k == 0:
                    first.extend(np.split(flat.astype(np.uint16 if len(v.bare) < 1 << 16 else np.int32), ends[:-1]))
            counts = np.concatenate([counts, np.column_stack(columns).astype(np.int32)])
            if known is self.words:
                self.counts = counts
        else:
            first, counts = self.first, self.counts
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return codes, counts, first


def repeated_words(codes: np.ndarray, doc: np.ndarray, docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document, the words inside windows that stand in it twice or more."""
    n = len(codes) - window + 1
    if n < 2:
        return np.zeros(docs, np.int64)
    words = mix(codes)
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    inside = np.flatnonzero(doc[:n] == doc[window - 1 :])
    h = mix(h[inside] ^ mix(mix(doc[inside])))
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(docs, np.int64)
    place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    starts = inside[twice[place] == h]
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(doc[covered], minlength=docs)


def entropies(tokens: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Bits per token, from each document's own token counts."""
    out = np.zeros(docs)
    if not len(tokens):
        return out
    keys = np.sort(doc.astype(np.int64) << 32 | tokens.astype(np.int64))
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([edges, [len(keys)]]))
    of = keys[edges] >> 32
    totals = np.bincount(doc, minlength=docs)[of]
    return np.bincount(of, -(counts / totals) * np.log2(counts / totals), minlength=docs)


def script_of(text: str) -> str:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = np.array([s for s, _ in SCRIPTS])
    letters = points[(points >= 0x41) & ~((points > 0x5A) & (points < 0x61)) & ~((points > 0x7A) & (points < 0xC0))]
    if not len(letters):
        return "none"
    blocks = np.bincount(np.searchsorted(starts, letters, "right") - 1, minlength=len(starts))
    return SCRIPTS[int(blocks.argmax())][1]


def _measured(texts: list[str], langs: list, measure: Measure) -> list[pa.Array]:
    raw = [t.encode() for t in texts]
    split = [b.split() for b in raw]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for s in split for w in s]
    doc = np.repeat(np.arange(len(texts)), n_words)
    codes, counts, first = measure.numbers(words)
    sums = [np.bincount(doc, counts[codes, k], minlength=len(texts)).astype(np.int64) for k in range(counts.shape[1])]
    pieces = [first[c] for c in codes.tolist()]
    tokens = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    of = np.repeat(doc, counts[codes, 0])
    lines = [[x for x in b.split(b"\n") if x.strip()] for b in raw]
    vocabularies = range(len(measure.vocabularies))
    return [
        pa.array(n_words),
        pa.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], pa.int64()),
        pa.array([sum(b.count(s) for s in SYMBOLS) for b in raw], pa.int64()),
        pa.array([len(x) - len(set(x)) for x in lines], pa.int64()),
        pa.array(repeated_words(codes, doc, len(texts))),
        pa.array([[int(sums[2 * k][i]) for k in vocabularies] for i in range(len(texts))], pa.list_(pa.int64())),
        pa.array([[int(sums[2 * k + 1][i]) for k in vocabularies] for i in range(len(texts))], pa.list_(pa.int64())),
        pa.array(entropies(tokens, of, len(texts))),
        pa.array([None if lang is not None else script_of(t) for t, lang in zip(texts, langs)], pa.string()),
    ]


def _measure_rows(paths: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = worker_state(("fertility", paths), lambda: Measure(paths))
        names = ["keys", *(p.split()[0] for p in METRICS.split(", "))]
        for batch in slices(batches, most=CHUNK):
            columns = _measured(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), measure)
            yield pa.RecordBatch.from_arrays([batch.column("keys"), *columns], names)

    return run


def measured(docs: DataFrame, paths: Sequence[str] | None = None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The keys (struct), the base figures, and tokens, bare bytes and entropy per text."""
    paths = tuple(paths or map(public_tokenizers.path, VOCABULARIES))
    rows = docs.select(F.struct(*(F.col(f"`{k}`") for k in keys)).alias("keys"), "lang", text_of().alias("text"))
    kind = rows.schema["keys"].dataType.simpleString()
    return rows.mapInArrow(_measure_rows(paths), f"keys {kind}, {METRICS}")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def length_pools(counts: DataFrame, texts: int) -> DataFrame:
    """Per group, which lengths (column bits) are compared together, as the first of them (column pool).

    Going up, lengths join until a pool has ``texts`` texts; a last pool with fewer joins
    the one before. ``counts`` has a row for each group and length.
    """
    ordered = counts.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("bits", F.col("count").alias("n")))).alias("lengths"))
    empty = "named_struct('starts', cast(array() as array<int>), 'n', 0L, 'pools', cast(array() as array<struct<bits:int,pool:int>>))"
    opens = f"size(a.starts) = 0 OR a.n >= {texts}"
    pooled = ordered.withColumn("a", F.expr(f"""aggregate(lengths, {empty}, (a, x) -> named_struct(
        'starts', if({opens}, array_append(a.starts, x.bits), a.starts),
        'n', if({opens}, 0L, a.n) + x.n,
        'pools', array_append(a.pools, named_struct('bits', x.bits, 'pool', if({opens}, x.bits, element_at(a.starts, -1))))))"""))
    last = F.when((F.col("a.n") < texts) & (F.size("a.starts") > 1), F.element_at("a.starts", -2)).otherwise(F.element_at("a.starts", -1))
    return pooled.select("group", F.explode("a.pools").alias("p"), last.alias("last")).select(
        "group", "p.bits", F.least("p.pool", "last").alias("pool")
    )


def judged(
    docs: DataFrame,
    paths: Sequence[str] | None = None,
    keys: Sequence[str] = ("doc_id",),
    spread: float = 10.0,
    least: tuple[float, float, float] = (0.08, 0.10, 0.12),
    most: tuple[float, float, float] = (0.25, 0.25, 0.20),
    short: int = 200,
    widest: float = 1.25,
    texts: int = 50,
) -> DataFrame:
    """Measure every text, fit the bands and give the verdict ``kept``.

    Characters per token and entropy must lie within ``spread`` median absolute deviations
    of their group's median, and not more than that above it for the byte share. Unlike
    quartiles, these stay those of the main kind of text while another kind has less than
    half of the rows. ``least`` and ``most`` are the narrowest and the widest half-width
    (shares of the median for characters per token and entropy, absolute for the byte
    share). Bands are wider for texts of few tokens, by sqrt(1 + short / tokens), at most
    by ``widest`` and never beyond ``most``. Groups are languages or, where it is null,
    scripts; entropy, which grows with length, is compared among texts of the same power
    of two of tokens, pooled with its neighbours below ``texts`` texts. Bands come from all
    documents that pass the base rules.

    Null and empty texts have no words and fail the base rules; null keys and repeated
    rows are kept as they are; other columns are not read. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        found = stored(measured(docs, paths, [*keys, "lang"]), "fertility")
    group = F.coalesce("keys.lang", F.concat(F.lit("script:"), "script"))
    count = len(paths or VOCABULARIES)
    tokens = F.greatest(F.col("n_tokens")[0], F.lit(1))
    rows = found.withColumns(
        {
            "base_failed": base_failed(),
            "group": group,
            "bits": F.floor(F.log2(tokens)).cast("int"),
            **{f"chars_{k}": F.col("word_chars") / F.greatest(F.col("n_tokens")[k], F.lit(1)) for k in range(count)},
            **{f"bare_{k}": F.col("n_bytes")[k] / F.greatest(F.col("n_tokens")[k], F.lit(1)) for k in range(count)},
        }
    )
    clean = rows.filter(~F.col("base_failed"))

    def off(column):
        return F.col(column) - F.col(f"mid_{column}")

    def fitted(rows, by, columns):
        """Medians, and the medians of distances from them."""
        mids = stored(rows.groupBy(*by).agg(*(F.percentile_approx(c, 0.5, 2000).alias(f"mid_{c}") for c in columns)), "medians")
        away = rows.join(mids, by).groupBy(*by).agg(*(F.percentile_approx(F.abs(off(c)), 0.5, 2000).alias(f"mad_{c}") for c in columns))
        return stored(mids.join(away, by), "bands")

    names = [f"{m}_{k}" for k in range(count) for m in ("chars", "bare")]
    pools = stored(length_pools(clean.groupBy("group", "bits").count(), texts), "lengths")
    bands = fitted(clean, ["group"], names)
    lengths = fitted(clean.join(pools, ["group", "bits"]), ["group", "pool"], ["entropy"])
    wider = F.least(F.sqrt(1 + short / tokens), F.lit(widest))

    def width(column, kind, unit):
        band = F.greatest(spread * F.col(f"mad_{column}"), least[kind] * unit) * wider
        return F.least(band, most[kind] * unit)

    inside = F.abs(off("entropy")) <= width("entropy", 2, F.col("mid_entropy"))
    for k in range(count):
        inside &= F.abs(off(f"chars_{k}")) <= width(f"chars_{k}", 0, F.col(f"mid_chars_{k}"))
        inside &= off(f"bare_{k}") <= width(f"bare_{k}", 1, F.lit(1.0))
    by_length = pools.join(lengths, ["group", "pool"])
    return (
        rows.join(bands, "group", "left").join(by_length, ["group", "bits"], "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
        .select("keys", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_bytes", "entropy", "group", "base_failed", "kept")
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep."""
    found = judged(docs.withColumn("text_key", text_key()), keys=("doc_id", "text_key"))
    rejected = stored(found.filter("NOT kept").select("keys.doc_id", "keys.text_key", "keys.lang").distinct(), "rejected")
    rows = keyed(docs).withColumn("lang", F.col("row.lang"))
    same = [rows[c].eqNullSafe(rejected[c]) for c in ("doc_id", "text_key", "lang")]
    few = rejected.count() * 64 <= BROADCAST_BYTES
    return rows.join(F.broadcast(rejected) if few else rejected, same[0] & same[1] & same[2], "left_anti").select("row.*")
