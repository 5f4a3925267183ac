"""Byte-level BPE encoding and decoding with a given rank file.

Every match of the split pattern is encoded on its own. Its bytes are the leaves of a segment tree;
a leaf holds the rank of the pair that starts at that byte and ends with the next live token, an
inner node the smallest rank below and its leftmost place. A merge takes the root, drops the right
token's leaf and renews at most two leaves, each in logarithmic time. Pieces recur, so every Python
worker remembers the ids of pieces, as bytes, within a memory bound.
"""

from __future__ import annotations

import base64
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from musterline.llm.text_hashing import given_back, slices, with_fields

#: About so many bytes of pieces and their ids are remembered by a worker during a task; when full, it starts anew.
REMEMBERED = 56 << 20
#: What an entry takes besides its characters and ids.
_ENTRY = 250
#: Segment trees that take their steps together.
ROWS = 4096
#: Ids that are decoded at a time.
DECODED = 1 << 18
_NONE = 1 << 40
_RUN = re.compile(r"\s\s").search


def _loose(text: str) -> bool:
    """Whether a space may meet other white space or an end of the text."""
    return not text or text[0] == " " or text[-1] == " " or _RUN(text) is not None


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank from lines of base64 and rank. A vocabulary is bounded (some MB)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        # Ids are kept as the bytes of int32 numbers.
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.held = 0
        # Every way to make a token of two tokens, as sorted pairs of ids.
        made = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs = np.array(sorted(made) or [-1], np.int64)
        self.pair_rank = np.array([made.get(int(x), _NONE) for x in self.pairs], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece: merges by smallest rank, leftmost first."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        # A node is rank * width + place: the smallest is the smallest rank at its leftmost place.
        shift = width.bit_length() - 1
        tree = [_NONE << shift] * (2 * width)
        get = ranks.get
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                tree[width + i] = rank << shift | i
        for node in range(width - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left <= right else right
        end = list(range(1, n + 1))  # where the token that starts here ends
        before = list(range(-1, n - 1))  # where the token before starts
        nothing = _NONE << shift

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                least = left if left <= right else right
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while (root := tree[1]) < nothing:
            at = root & (width - 1)
            middle = end[at]
            stop = end[middle]
            end[at] = stop
            if stop < n:
                before[stop] = at
                rank = get(piece[at : end[stop]])
            else:
                rank = None
            put(middle, nothing)
            put(at, nothing if rank is None else rank << shift | at)
            if at:
                left = before[at]
                rank = get(piece[left:stop])
                put(left, nothing if rank is None else rank << shift | left)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """:meth:`merge` for many pieces at once."""
        return [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in self._merged(pieces)]

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pieces, one row of arrays for each piece.

        The rows' segment trees take their steps together: per turn every unfinished row makes its
        next merge, and the changed leaves climb their trees level by level.
        """
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, sys.byteorder)
            elif len(piece) > 64:
                out[i] = np.array(self.merge(piece), np.int32).tobytes()
            else:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, places in by_width.items():
            for start in range(0, len(places), ROWS):
                part = places[start : start + ROWS]
                for i, ids in zip(part, self._merge_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_rank[at], _NONE)

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        rows, shift = len(pieces), width.bit_length() - 1
        n = np.array([len(p) for p in pieces])
        inside = np.arange(width) < n[:, None]
        token = np.zeros((rows, width + 1), np.int64)
        token[:, :-1][inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        places = np.arange(width)
        tree = np.full((rows, 2 * width), _NONE << shift, np.int64)
        ranks = np.full((rows, width), _NONE)
        pair = inside[:, 1:]
        ranks[:, :-1][pair] = self._pair_ranks(token[:, : width - 1][pair], token[:, 1:width][pair])
        tree[:, width:] = np.where(ranks < _NONE, ranks << shift | places, _NONE << shift)
        size = width
        while size > 1:
            size //= 2
            tree[:, size : 2 * size] = tree[:, 2 * size : 4 * size].reshape(rows, size, 2).min(axis=2)
        end = np.tile(np.arange(1, width + 2), (rows, 1))
        before = np.tile(np.arange(-1, width), (rows, 1))
        live = inside.copy()
        nothing, flat = _NONE << shift, tree.reshape(-1)
        row = np.arange(rows)
        while True:
            row = row[tree[row, 1] < nothing]
            if not len(row):
                break
            root = tree[row, 1]
            at, rank = root & (width - 1), root >> shift
            middle = end[row, at]
            stop = end[row, middle]
            token[row, at], end[row, at], before[row, stop] = rank, stop, at
            live[row, middle] = False
            left = before[row, at]
            follows, leads = stop < n[row], left >= 0
            base = row * (2 * width) + width
            flat[base + middle] = nothing
            new = np.where(follows, self._pair_ranks(rank, token[row, stop]), _NONE)
            flat[base + at] = np.where(new < _NONE, new << shift | at, nothing)
            new = self._pair_ranks(token[row, left][leads], rank[leads])
            flat[(base + left)[leads]] = np.where(new < _NONE, new << shift | left[leads], nothing)
            nodes = np.concatenate([width + middle, width + at, (width + left)[leads]])
            of = np.concatenate([row, row, row[leads]]) * (2 * width)
            for _ in range(shift):
                nodes >>= 1
                flat[of + nodes] = np.minimum(flat[of + 2 * nodes], flat[of + 2 * nodes + 1])
        ids = token[:, :-1][live].astype(np.int32).tobytes()
        cuts = [0, *(4 * np.cumsum(live.sum(axis=1))).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def forget(self) -> None:
        """Drops the remembered pieces; the vocabulary stays."""
        self.known, self.spaced, self.held = {}, {}, 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as the bytes of int32 numbers; null has none.

        A space between two other characters that are no white space begins a match of the pattern, so
        what lies between such spaces is encoded and remembered on its own. A text in which a space
        meets other white space is split by the pattern as a whole.
        """
        known, spaced, split = self.known, self.spaced, self.split
        if self.held > REMEMBERED:
            known.clear()
            spaced.clear()
            self.held = 0
        parts = [[None, t] if not t or _loose(t) else t.split(" ") for t in texts]
        loose = [p[0] is None for p in parts]
        heads = [split((p[1] if alone else p[0]) or "") for p, alone in zip(parts, loose)]
        new = {x for p, alone in zip(parts, loose) if not alone for x in p[1:]} - spaced.keys()
        cut = {x: split(" " + x) for x in new}
        pieces = list(({x for xs in cut.values() for x in xs} | {x for xs in heads for x in xs}) - known.keys())
        merged = self._merged([p.encode("utf-8") for p in pieces])
        known.update(zip(pieces, merged))
        for x, xs in cut.items():
            spaced[x] = known[xs[0]] if len(xs) == 1 else b"".join([known[y] for y in xs])
        self.held += _ENTRY * (len(pieces) + len(cut)) + sum(map(len, merged)) + sum(map(len, pieces)) + sum(map(len, cut))
        return [
            b"".join([known[x] for x in head] + ([] if alone else list(map(spaced.__getitem__, p[1:]))))
            for p, alone, head in zip(parts, loose, heads)
        ]


_encoders: dict[tuple, Encoder] = {}


def _encoder(sent, pattern: str) -> Encoder:
    """One encoder per worker, vocabulary and pattern, so that its pairs of tokens outlive a task."""
    key = (sent.value[0], pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(sent.value[1], pattern)
    return _encoders[key]


def _encoding(spark: SparkSession, ranks: dict[bytes, int], pattern: str, text: str, ids: str):
    """What adds the ids to batches of texts."""
    sent = spark.sparkContext.broadcast((hash(frozenset(ranks.items())), ranks))

    def encoded(batches):
        encoder = _encoder(sent, pattern)
        try:
            for part in slices(batches, text, size=2 << 20):
                found = encoder.encode(part.column(text).to_pylist())
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                flat = np.frombuffer(b"".join(found), np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.record_batch([*part.columns, column], names=[*part.schema.names, ids])
        finally:
            # An idle worker holds no pieces: they would stay while the worker serves other stages.
            encoder.forget()
            given_back()

    return encoded


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>) of each whole text; a null text has no ids.

    Without special tokens. All columns stay; one that is already called ``ids`` is replaced.
    """
    kept = docs.drop(ids)
    encoded = _encoding(docs.sparkSession, ranks, pattern, text, ids)
    return kept.mapInArrow(encoded, with_fields(kept.schema, f"`{ids}` array<int>"))


def _decoding(spark: SparkSession, ranks: dict[bytes, int], ids: str, decoded: str):
    """What adds the decoded bytes to batches of ids."""
    table = [b""] * (max(ranks.values(), default=-1) + 2)
    for token, rank in ranks.items():
        table[rank] = token
    lengths = np.array([len(t) for t in table])
    sent = spark.sparkContext.broadcast((b"".join(table), lengths, np.cumsum(lengths) - lengths))

    def decoding(batches):
        joined, lengths, starts = sent.value
        joined = np.frombuffer(joined, np.uint8)

        def bytes_of(found):
            size = lengths[found]
            ends = np.cumsum(size)
            return joined[np.arange(size.sum()) + np.repeat(starts[found] - ends + size, size)]

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = pc.fill_null(part.column(ids), pa.scalar([], part.column(ids).type))
                bounds = lists.offsets.to_numpy()
                found = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
                ends = np.zeros(len(found) + 1, np.int64)
                np.cumsum(lengths[found], out=ends[1:])
                data = np.empty(ends[-1], np.uint8)
                for i in range(0, len(found), DECODED):
                    some = found[i : i + DECODED]
                    data[ends[i] : ends[i + len(some)]] = bytes_of(some)
                texts = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(lists), [None, pa.py_buffer(ends[bounds - bounds[0]]), pa.py_buffer(data)]
                ).cast(pa.binary())
                yield pa.record_batch([*part.columns, texts], names=[*part.schema.names, decoded])

    return decoding


def decode_ids(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids as ``decoded`` (binary); null ids are no bytes.

    All columns stay; one that is already called ``decoded`` is replaced.
    """
    kept = df.drop(decoded)
    decoding = _decoding(df.sparkSession, ranks, ids, decoded)
    return kept.mapInArrow(decoding, with_fields(kept.schema, f"`{decoded}` binary"))


def encoded_and_decoded(spark: SparkSession, docs: DataFrame, rank_file: str | None = None) -> DataFrame:
    """``docs`` with ids, n_tokens, decoded bytes and the digests of both."""
    import public_tokenizers

    ranks = load_ranks(spark, rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    kept = docs.drop("ids", "decoded")
    encoding = _encoding(spark, ranks, public_tokenizers.PATTERN, "text", "ids")
    decoding = _decoding(spark, ranks, "ids", "decoded")
    # One pass through Python: the ids are decoded where they were made.
    both = kept.mapInArrow(lambda batches: decoding(encoding(batches)), with_fields(kept.schema, "ids array<int>, decoded binary"))
    return both.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256),
            "decoded_sha256": F.sha2("decoded", 256),
        }
    )


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded bytes of every document; a null text is empty, repeated rows give equal rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded_and_decoded(spark, docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def stage_byte_bpe(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; ``round_trip`` says whether decoding gives back its bytes.

    The last stage: only doc_id stays of the documents' columns. Null texts have no ids, repeated rows stay.
    """
    both = encoded_and_decoded(spark, docs.select("doc_id", "text"))
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return both.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", same.alias("round_trip"))
