"""BPE encoding and decoding with tree concatenation for long unsplit text.

A tokenizer that drops white space encodes each word by itself. Words are looked up in a
bounded cache of the worker and the rest go to the library. A word longer than
``piece_chars`` is cut into halves until its pieces fit; pieces are rows of their own and
are encoded in parallel. Neighbours are then joined up the tree: a window around each join
is encoded again and grows until it has tokens in common with both sides, and its tokens
replace what lies between.

Two sequences that share a token at the same place may be joined there: an encoding is
the library's own if each pair of neighbouring tokens is, and all pairs of the joined
sequence occur in one of the two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm.common import SPACE, slices, text_of, worker_state

#: Entries of a worker's word cache; at about 200 bytes each. Rarer words are encoded anew.
CACHE_WORDS = 450_000
#: Neighbouring tokens that both sides must share before they count as agreed.
AGREE = 2

def tokenizer(path: str) -> Tokenizer:
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _worker_state(path: str) -> tuple[Tokenizer, dict[bytes, bytes]]:
    return worker_state(("bpe", path), lambda: (tokenizer(path), {}))


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode_words(words: set[bytes], tok: Tokenizer) -> dict[bytes, bytes]:
    order = list(words)
    got = tok.encode_batch_fast([w.decode() for w in order], add_special_tokens=False)
    return dict(zip(order, (_packed(e.ids) for e in got)))


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, cache = _worker_state(path)
        for batch in slices(batches, most=1 << 20):
            split = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rare: dict[bytes, bytes] = {}
            new = {w for words in split for w in set(words) if w not in cache}
            if new:
                fresh = encode_words(new, tok)
                (cache if len(cache) < CACHE_WORDS else rare).update(fresh)
            if rare:
                found = [b"".join([cache.get(w) or rare.get(w, b"") for w in words]) for words in split]
            else:
                found = [b"".join(map(cache.__getitem__, words)) for words in split]
            yield _with_decoded(batch, found, tok)

    return run


def _with_decoded(batch: pa.RecordBatch, found: list[bytes], tok: Tokenizer) -> pa.RecordBatch:
    decoded = [tok.decode(np.frombuffer(b, "<u4").tolist(), skip_special_tokens=False) for b in found]
    return pa.RecordBatch.from_arrays(
        [batch.column("keys"), pa.array(found, pa.binary()), pa.array(decoded, pa.string())], ["keys", "ids", "decoded"]
    )


def pieces(word: str, limit: int) -> list[str]:
    """Halves of halves, until each has at most ``limit`` characters."""
    if len(word) <= limit:
        return [word]
    middle = len(word) // 2
    return pieces(word[:middle], limit) + pieces(word[middle:], limit)


def _cut_long(limit: int):
    """Rows (row, word, piece, text): long words in pieces, those between them as one text."""
    def run(batches):
        for batch in batches:
            rows, words, numbers, texts = [], [], [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                parts: list[list[str]] = []
                short: list[bytes] = []
                for word in text.split():
                    decoded = word.decode()
                    if len(decoded) > limit:
                        parts += [[b" ".join(short).decode()]] * bool(short) + [pieces(decoded, limit)]
                        short = []
                    else:
                        short.append(word)
                parts += [[b" ".join(short).decode()]] * bool(short)
                for w, part in enumerate(parts):
                    for p, piece in enumerate(part):
                        rows.append(row)
                        words.append(w)
                        numbers.append(p)
                        texts.append(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.string()), pa.array(words, pa.int32()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string())],
                ["row", "word", "piece", "piece_text"],
            )

    return run


def encoded_at(text: str, tok: Tokenizer, at: int = 0) -> np.ndarray:
    """Tokens as rows (id, start, end), places counted from ``at``."""
    e = tok.encode(text, add_special_tokens=False)
    spans = np.asarray(e.offsets, np.int64).reshape(-1, 2) + at
    return np.column_stack([np.asarray(e.ids, np.int64), spans])


def _encode_pieces(path: str):
    def run(batches):
        tok, _ = _worker_state(path)
        for batch in batches:
            got = [encoded_at(t, tok).astype("<i8").tobytes() for t in batch.column("piece_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "word", "piece", "piece_text")] + [pa.array(got, pa.binary())],
                ["row", "word", "piece", "piece_text", "tokens"],
            )

    return run


def _clean(tokens: np.ndarray) -> np.ndarray:
    """Tokens that share no character with a neighbour: where sequences may be joined."""
    ok = np.ones(len(tokens), bool)
    ok[1:] &= tokens[1:, 1] >= tokens[:-1, 2]
    ok[:-1] &= tokens[:-1, 2] <= tokens[1:, 1]
    return ok


def _common(side: np.ndarray, window: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (index in side, index in window) that end a run of AGREE equal tokens."""
    clean_side, clean_window = _clean(side), _clean(window)
    where = {tuple(t): i for i, t in enumerate(side.tolist()) if clean_side[i]}
    found, run, last = [], 0, -2
    for j, t in enumerate(window.tolist()):
        i = where.get(tuple(t), -2) if clean_window[j] else -2
        run = run + 1 if i >= 0 and (run == 0 or i == last + 1) else int(i >= 0)
        last = i
        if run >= AGREE:
            found.append((i, j))
    return found


def joined(left: np.ndarray, right: np.ndarray, text: str, low: int, cut: int, high: int, tok: Tokenizer) -> np.ndarray:
    """The tokens of text[low:high] from those of its halves, which meet at ``cut``."""
    reach = 64
    while True:
        start, stop = max(low, cut - reach), min(high, cut + reach)
        window = encoded_at(text[start:stop], tok, start)
        if start == low and stop == high:
            return window
        near_left = left[left[:, 2] > start]
        skipped = len(left) - len(near_left)
        near_right = right[right[:, 1] < stop]
        # The last place agreed on the left, and the first on the right, after it.
        a = (-1, -1) if start == low else next(iter(_common(near_left, window)), None)
        b = (len(near_right), len(window)) if stop == high else next(reversed(_common(near_right, window)), None)
        if a and b and a[1] < b[1]:
            i = skipped + a[0] if start > low else -1
            return np.concatenate([left[: i + 1], window[a[1] + 1 : b[1]], right[b[0] :]])
        reach *= 2


def concatenate(parts: list[tuple[str, np.ndarray]], tok: Tokenizer) -> np.ndarray:
    """Join the pieces of one word pairwise up the tree."""
    text = "".join(p for p, _ in parts)
    level, at = [], 0
    for piece, tokens in parts:
        level.append((at, at + len(piece), tokens + np.array([0, at, at])))
        at += len(piece)
    while len(level) > 1:
        level = [
            (a[0], b[1], joined(a[2], b[2], text, a[0], a[1], b[1], tok))
            for a, b in zip(level[::2], level[1::2])
        ] + level[len(level) - len(level) % 2 :]
    return level[0][2]


def _join_row(path: str):
    def run(group: pa.Table) -> pa.Table:
        tok, _ = _worker_state(path)
        group = group.sort_by([("word", "ascending"), ("piece", "ascending")])
        words: dict[int, list] = {}
        for w, text, tokens in zip(*(group.column(c).to_pylist() for c in ("word", "piece_text", "tokens"))):
            words.setdefault(w, []).append((text, np.frombuffer(tokens, "<i8").reshape(-1, 3)))
        ids = b"".join(_packed(concatenate(p, tok)[:, 0]) for p in words.values())
        decoded = tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        return pa.table({"row": group.column("row").slice(0, 1), "ids": [ids], "decoded": [decoded]},
                        schema=pa.schema([("row", pa.string()), ("ids", pa.binary()), ("decoded", pa.string())]))

    return run


def encode(docs: DataFrame, path: str, piece_chars: int = 4096) -> DataFrame:
    """Encode and decode the column ``text``; all columns stay, as the struct ``keys``.

    Returns keys (struct of the columns but text), ids (little-endian unsigned 32-bit integers) and
    decoded (the library's decoding of the ids). Null and empty texts give no ids.
    Repeated rows are rows of their own; clashing column names are safe inside keys. The
    tokenizer must drop white space, else a ValueError is raised.
    """
    tok = tokenizer(path)
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    if ids("a b\t\nc") != ids("a") + ids("b") + ids("c"):
        raise ValueError("the tokenizer keeps white space; words can't be encoded one by one")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("keys"), text_of().alias("text"))
    long = (F.length("text") > piece_chars) & F.regexp_like("text", F.lit(rf"[^{SPACE}]{{{piece_chars + 1}}}"))
    kind = rows.schema["keys"].dataType.simpleString()
    short = rows.filter(~long).mapInArrow(_encode_short(path), f"keys {kind}, ids binary, decoded string")
    # A long text is named by its digest, so equal texts are cut, encoded and joined once.
    named = rows.filter(long).withColumn("row", F.sha2("text", 256))
    cut = named.select("row", "text").mapInArrow(
        _cut_long(piece_chars), "row string, word int, piece int, piece_text string"
    )
    encoded = cut.dropDuplicates(["row", "word", "piece"]).mapInArrow(
        _encode_pieces(path), "row string, word int, piece int, piece_text string, tokens binary"
    )
    done = encoded.groupBy("row").applyInArrow(_join_row(path), "row string, ids binary, decoded string")
    return short.unionByName(named.select("row", "keys").join(done, "row").drop("row"))
