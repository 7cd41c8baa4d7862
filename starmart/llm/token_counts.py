"""Token counts through distinct pre-tokens.

A tokenizer first cuts a text into pre-tokens, and how many tokens a pre-token becomes
does not depend on what is around it. So token ids are never made per document:

1. every distinct pre-token of all documents is counted, with its occurrences;
2. the tokenizer's model cuts each distinct pre-token once;
3. documents join their own pre-token frequencies to those numbers and add them up.

The COMMON most frequent pre-tokens travel to the documents as a table of bounded size (an
entry has at most KEY_BYTES bytes; a longer pre-token goes by its digest); most occurrences
are theirs. What a document has of all others is shuffled by pre-token and joined there; as
the frequent ones are gone, no pre-token is hot. Both ways serve any amount of data.

Texts repeat themselves long before they are cut: a byte-level tokenizer always cuts where
a space or line feed follows something else, so tasks cut the bytes of a batch there,
dictionary-encode the chunks, and pre-tokenize each distinct one once. Other tokenizers
pre-tokenize whole texts.

Special tokens that the tokenizer finds inside texts count one each, which is its default.
No begin or end token is added, nothing is truncated or padded. ``tokenizer`` is the
content of a tokenizers file (.json), read by the caller; files whose special tokens
strip white space or match whole words only are refused.

Defined results: NULL and empty texts have no bytes and no tokens. Bytes that are not
UTF-8 are counted as they are, and tokenized as U+FFFD. Repeated rows, and rows without
id, get a result each. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmart.llm.common import written

COMMON = 1 << 18
KEY_BYTES = 64
# Distinct chunks that a task holds before it passes them on, or forgets them.
HELD = 500_000
# Bytes of text that a task cuts at once, if they are not one text.
PART_BYTES = 1 << 23
LIMIT = 512

# How a byte-level tokenizer writes a space and a line feed.
SPACE_BYTE, LINE_BYTE = "\u0120", "\u010a"

# Chunks whose pre-tokens are known without the tokenizer: at most one line feed and one
# space, letters, and marks but the apostrophe, which may start a contraction.
PLAIN = re.compile(
    r"(\n?)( ?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*)([!-&(-/:-@\[-`{-~]*)\Z"
)


def byte_signs() -> dict[int, int]:
    """The character by which a byte-level tokenizer writes each byte: itself if Latin-1
    prints it, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: 256 + place for place, byte in enumerate(hidden)}


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the UTF-8 texts that begin at ``starts`` may be cut: before each space or line
    feed that follows no white space, and at the start of every text."""
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        last = data[:-1]
        cut[1:] = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & (last > 0x20)
        # White space beyond ASCII has two or three bytes.
        cut[2:] &= ~((data[:-2] == 0xC2) & ((last[1:] == 0x85) | (last[1:] == 0xA0)))
        one, two, three = data[:-3], data[1:-2], data[2:-1]
        space = (one == 0xE1) & (two == 0x9A) & (three == 0x80)
        space |= (one == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three >= 0xA8))
        space |= (one == 0xE2) & (two == 0x81) & (three == 0x9F)
        space |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
        cut[3:] &= ~space
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


class PreTokens:
    """Cuts texts as the tokenizer does before its model comes in."""

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        added = json.loads(content).get("added_tokens") or []
        for token in added:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"special token {token['content']!r} depends on its surroundings")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        cut = json.loads(content).get("pre_tokenizer") or {}
        self.by_chunk = (
            self.tokenizer.normalizer is None
            and cut.get("type") == "ByteLevel"
            and cut["use_regex"]
            and not cut["add_prefix_space"]
            and not any(re.search(r"\s", name) for name in names)
        )
        self.signs = byte_signs()

    def pieces(self, part: str) -> list[str]:
        """The pre-tokens of a part of a text that has no special token."""
        if self.tokenizer.normalizer:
            part = self.tokenizer.normalizer.normalize_str(part)
        if not part:
            return []
        cut = self.tokenizer.pre_tokenizer
        return [piece for piece, _ in cut.pre_tokenize_str(part)] if cut else [part]

    def whole(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and the number of its special tokens."""
        parts = self.special.split(text) if self.special else [text]
        return [piece for part in parts for piece in self.pieces(part)], len(parts) - 1

    def pieces_of(self, chunk: str) -> tuple[list[str], int]:
        """The pre-tokens of a chunk (see ``chunks``), and the number of its special tokens."""
        if not self.by_chunk:
            return [chunk], 0
        plain = PLAIN.match(chunk)
        if not plain or not (plain[3] or plain[4]):
            return self.whole(chunk)
        if self.special and self.special.search(chunk):
            return self.whole(chunk)
        line, space, word, marks = plain.groups()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.signs)
        first = (SPACE_BYTE if space else "") + (word or marks)
        found = [LINE_BYTE, first] if line else [first]
        return ([*found, marks] if word and marks else found), 0

    def chunks(self, raw: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """The chunks of all texts of a batch: of each the number of its text and its place
        among the distinct ones; these; and the special tokens of each text that are in no
        chunk. A tokenizer whose cuts are not known has pre-tokens as chunks."""
        texts, specials = utf8(raw), np.zeros(len(raw), dtype=np.int64)
        if not self.by_chunk:
            found = [self.whole(text.decode()) for text in texts.to_pylist()]
            text_no = np.repeat(np.arange(len(found)), [len(pieces) for pieces, _ in found])
            texts = pa.array([p.encode() for pieces, _ in found for p in pieces], pa.binary())
            specials += np.fromiter((n for _, n in found), np.int64, len(found))
        elif not pc.sum(pc.binary_length(texts)).as_py():
            texts, text_no = texts[:0], np.zeros(0, dtype=np.int64)
        else:
            size = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1)
            data = np.frombuffer(texts.buffers()[2], dtype=np.uint8, count=size[-1])
            begins = chunk_starts(data, size[:-1])
            text_no = np.searchsorted(size[1:], begins, side="right")
            ends = np.append(begins, size[-1]).astype(np.int32)
            texts = pa.Array.from_buffers(
                pa.binary(), len(begins), [None, pa.py_buffer(ends), texts.buffers()[2]]
            )
        coded = texts.dictionary_encode()
        return text_no, coded.indices.to_numpy(), coded.dictionary, specials

    def size(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(piece))


def key_of(piece: str) -> bytes:
    raw = piece.encode()
    return raw if len(raw) < KEY_BYTES else b"\0" + hashlib.blake2b(raw, digest_size=32).digest()


def utf8(raw: pa.Array) -> pa.Array:
    """Texts of a batch in one run of bytes from 0 on; NULL is empty, and what is not UTF-8
    becomes U+FFFD."""
    raw = raw.fill_null(b"")
    try:
        raw.cast(pa.string())
    except pa.ArrowInvalid:
        whole = [text.decode("utf-8", "replace").encode() for text in raw.to_pylist()]
        return pa.array(whole, pa.binary())
    return pa.concat_arrays([raw[:0], raw])


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about PART_BYTES of text; a longer text is one alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch["raw"]), 0).to_numpy().astype(np.int64)
        part = (np.cumsum(size) - size) // PART_BYTES
        begins = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            yield batch.slice(begin, end - begin)


def without_model(content: str) -> str:
    """A tokenizer's file without the vocabulary, which cutting does not need."""
    kept = json.loads(content)
    kept["model"] = {"type": "BPE", "vocab": {}, "merges": []}
    kept["post_processor"] = kept["truncation"] = kept["padding"] = None
    return json.dumps(kept)


def piece_occurrences(docs: DataFrame, cutter) -> DataFrame:
    """piece and n of every distinct pre-token of (raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held = PreTokens(cutter.value), Counter()

        def rows() -> pa.RecordBatch:
            pieces: Counter = Counter()
            for chunk, n in held.items():
                for piece in cut.pieces_of(chunk.decode())[0]:
                    pieces[piece] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(pieces.keys(), pa.string()), pa.array(pieces.values(), pa.int64())],
                names=["piece", "n"],
            )

        for batch in parts_of(batches):
            _, code, distinct, _ = cut.chunks(batch["raw"])
            times = np.bincount(code, minlength=len(distinct)).tolist()
            for chunk, n in zip(distinct.to_pylist(), times, strict=True):
                held[chunk] += n
            if len(held) > HELD:
                yield rows()
                held.clear()
        yield rows()

    found = docs.select("raw").mapInArrow(run, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def piece_sizes(pieces: DataFrame, content) -> DataFrame:
    """key, n and n_tokens of every distinct pre-token: here, and only here, the model runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = PreTokens(content.value)
        for batch in batches:
            own = batch["piece"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key_of(p) for p in own], pa.binary()),
                    batch["n"],
                    pa.array([cut.size(p) for p in own], pa.int64()),
                ],
                names=["key", "n", "n_tokens"],
            )

    return pieces.mapInArrow(run, "key binary, n long, n_tokens long")


def summed(cutter, common) -> Callable:
    """doc_id, n_bytes, n_tokens (specials and common pre-tokens) and rest (all others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, sizes = PreTokens(cutter.value), common.value
        # Of each chunk: tokens of its common pre-tokens, and the keys of its others.
        known: dict[bytes, tuple[int, tuple[bytes, ...]]] = {}

        def valued(chunk: bytes) -> tuple[int, tuple[bytes, ...]]:
            pieces, size = cut.pieces_of(chunk.decode())
            others = []
            for key in map(key_of, pieces):
                if (own := sizes.get(key)) is None:
                    others.append(key)
                else:
                    size += own
            known[chunk] = size, tuple(others)
            return known[chunk]

        for batch in parts_of(batches):
            if len(known) > HELD:
                known.clear()
            text_no, code, distinct, tokens = cut.chunks(batch["raw"])
            values = [known.get(c) or valued(c) for c in distinct.to_pylist()]
            size = np.fromiter((v[0] for v in values), np.int64, len(values))
            np.add.at(tokens, text_no, size[code])
            # A row for each other pre-token of a chunk, then of a text with its frequency.
            keys = [key for v in values for key in v[1]]
            n_keys = np.fromiter((len(v[1]) for v in values), np.int64, len(values))
            coded = pa.array(keys, pa.binary()).dictionary_encode()
            key_no, first = coded.indices.to_numpy(), np.cumsum(n_keys) - n_keys
            times = n_keys[code]
            inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            own_key = key_no[np.repeat(first[code], times) + inside].astype(np.int64)
            n_distinct = max(len(coded.dictionary), 1)
            pair, n = np.unique(
                np.repeat(text_no, times) * n_distinct + own_key, return_counts=True
            )
            rest = pa.StructArray.from_arrays(
                [coded.dictionary.take(pa.array(pair % n_distinct)), pa.array(n, pa.int64())],
                names=["key", "n"],
            )
            offsets = np.searchsorted(pair // n_distinct, np.arange(batch.num_rows + 1))
            raw = batch["raw"]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pc.fill_null(pc.binary_length(raw), 0).cast(pa.int64()),
                    pa.array(tokens),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "rest"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs`` (doc_id, text)."""
    context = docs.sparkSession.sparkContext
    content = context.broadcast(tokenizer)
    cutter = context.broadcast(without_model(tokenizer))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw")
    )
    sizes = written(piece_sizes(piece_occurrences(rows, cutter), content), "piece_sizes")
    most = sizes.orderBy(F.desc("n"), "key").limit(common).select("key", "n_tokens").toArrow()
    table = dict(zip(most["key"].to_pylist(), most["n_tokens"].to_pylist(), strict=True))
    own = rows.mapInArrow(
        summed(cutter, context.broadcast(table)),
        "doc_id long, n_bytes long, n_tokens long, rest array<struct<key:binary,n:long>>",
    ).withColumn("row", F.monotonically_increasing_id())
    # Written, so that a row keeps its number whatever has to be computed again.
    own = written(own, "own_counts")
    others = (
        own.select("row", F.inline("rest"))
        .join(sizes.select("key", F.col("n_tokens").alias("size")), "key")
        .groupBy("row")
        .agg(F.sum(F.col("n") * F.col("size")).alias("others"))
    )
    return own.join(others, "row", "left").select(
        "doc_id",
        "n_bytes",
        (F.col("n_tokens") + F.coalesce("others", F.lit(0))).alias("n_tokens"),
    )
