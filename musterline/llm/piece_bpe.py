"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies with byte fallback.

White space becomes the sign ``▁`` and one is put in front. All adjacent pairs of symbols whose
concatenation is a piece stand in an agenda ordered by the piece's score, then by place. The first pair
is merged and the pairs it now forms with its neighbours are entered, until the agenda is empty. The agendas
of short segments are rows of one array, and many take their steps together; a long one is a heap. Merges
never cross a border between two characters that stand side by side in no piece, so what lies between
such borders (in these vocabularies: between words) is encoded on its own and remembered by the worker.
The same Arrow batch is encoded and decoded by the sentencepiece library as well, and each row says
whether both agree.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from musterline.llm.text_hashing import slices, with_fields

#: About so many bytes of segments and their ids are remembered by a worker; when full, it starts anew.
REMEMBERED = 160 << 20
#: What an entry takes besides its characters and ids.
_ENTRY = 200
#: Segments from here on have an agenda of their own; they are cut at every border first.
LONG = 33
#: Agendas that take their steps together.
ROWS = 4096
SPACE = "▁"
#: A sign that no text should hold; columns with one are cut by Python.
MARK = "\U0010ffff"
# Numbers of fields and types in the model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2


def _fields(data: bytes):
    """(number, value) of a serialised message: whole numbers and byte strings."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("musterline_each_byte", _each_byte)


class Vocabulary:
    """The pieces of a model; ValueError for models that this encoder does not cover.

    Covered: merge-type models with byte fallback, one sign in front of a text, no character map,
    white space kept as it is, and no user-defined or unused pieces.
    """

    def __init__(self, model: bytes):
        self.model = model
        pieces, settings = [], {}
        for number, value in _fields(model):
            if number == _PIECES:
                pieces.append(dict(_fields(value)))
            elif number in (_TRAINER, _NORMALIZER):
                settings[number] = dict(_fields(value))
        trainer, normalizer = settings.get(_TRAINER, {}), settings.get(_NORMALIZER, {})
        self.text = [p[1].decode() for p in pieces]
        self.kind = [p.get(3, _NORMAL) for p in pieces]
        covered = (
            trainer.get(3, 1) == _BPE
            and trainer.get(35, 0) == 1  # byte fallback
            and trainer.get(24, 0) == 0  # white space before words
            and not normalizer.get(2)  # character map
            and normalizer.get(3, 1) == 1  # sign in front
            and normalizer.get(4, 1) == 0  # white space kept
            and normalizer.get(5, 1) == 1  # white space as a sign
            and set(self.kind) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        )
        if not covered:
            raise ValueError("this kind of sentencepiece model is not covered")
        scores = [struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces]
        order = {s: i for i, s in enumerate(sorted(set(scores), reverse=True))}
        normal = [i for i, kind in enumerate(self.kind) if kind == _NORMAL]
        #: Piece to the place of its score, the best first; equal scores have equal places.
        self.rank = {self.text[i]: order[scores[i]] for i in normal}
        self.id = {self.text[i]: i for i in normal}
        self.byte_id = [0] * 256
        for i, kind in enumerate(self.kind):
            if kind == _BYTE:
                self.byte_id[int(self.text[i][3:5], 16)] = i
        self.end_id = self.text.index("</s>")
        #: Characters that stand side by side in some piece.
        self.joined = {t[i : i + 2] for t in self.rank for i in range(len(t) - 1)}
        # Symbols: the pieces, and characters that only occur within pieces.
        symbols = {t: i for i, t in enumerate(self.text) if t in self.rank}
        for c in sorted({c for t in self.rank for c in t} - symbols.keys()):
            symbols[c] = len(self.text) + len(symbols)
        made = {
            symbols[t[:i]] << 32 | symbols[t[i:]]: (r, symbols[t])
            for t, r in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in symbols and t[i:] in symbols
        }
        #: Pairs of symbols that form a piece, their score's place, and the piece.
        self.pairs = np.array(sorted(made) or [-1], np.int64)
        self.pair_rank = np.array([made.get(int(x), (0, 0))[0] for x in self.pairs], np.int64)
        self.pair_makes = np.array([made.get(int(x), (0, 0))[1] for x in self.pairs], np.int64)
        # Characters that become one id by themselves: pieces, and those of one byte.
        lone = {t: symbols[t] for t in self.id if len(t) == 1}
        lone |= {chr(b): self.byte_id[b] for b in range(128) if chr(b) not in symbols}
        self.single = set(lone)
        self.codes = np.array([ord(t) for t in sorted(lone)], np.uint32)
        self.code_ids = np.array([lone[t] for t in sorted(lone)], np.int64)
        #: ASCII characters in no piece: a border on both sides.
        self.apart = "".join(chr(b) for b in range(128) if chr(b) not in symbols)
        self.cut_at_spaces = not any(j[1] == SPACE and j[0] != SPACE for j in self.joined)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}
        self.held = 0
        apart = re.escape(vocabulary.apart)
        inner = f"[^{SPACE}{apart}]"
        borders = re.compile(f"{SPACE}+{inner}*|{inner}+" + (f"|[{apart}]+" if apart else ""))
        self.split = borders.findall if vocabulary.cut_at_spaces else lambda t: [t]
        #: Besides runs of white space, borders of a column: a line feed, if it is in no piece.
        self.lines = "\n" in vocabulary.apart

    def merge(self, s: str) -> list[int]:
        """Piece ids of a segment: adjacent pairs by score, the best and leftmost first."""
        n, rank_of = len(s), self.v.rank.get
        numbers = list if n < LONG else (lambda values: array("q", values))
        end = numbers(range(1, n + 1))  # where the symbol that starts here ends
        before = numbers(range(-1, n - 1))  # where the symbol before starts
        rank = numbers([-1] * n)  # of the pair that starts here; -1: none
        agenda = []
        for i in range(n - 1):
            r = rank_of(s[i : i + 2])
            if r is not None:
                rank[i] = r
                agenda.append(r << 40 | i)
        heapify(agenda)
        while agenda:
            first = heappop(agenda)
            at = first & 0xFFFFFFFFFF
            if rank[at] != first >> 40:
                continue  # one of the two has been merged otherwise
            middle = end[at]
            stop = end[at] = end[middle]
            rank[middle] = rank[at] = -1
            if stop < n:
                before[stop] = at
                r = rank_of(s[at : end[stop]])
                if r is not None:
                    rank[at] = r
                    heappush(agenda, r << 40 | at)
            left = before[at]
            if left >= 0:
                r = rank_of(s[left:stop])
                rank[left] = -1 if r is None else r
                if r is not None:
                    heappush(agenda, r << 40 | left)
        ids, at, id_of, byte_id = [], 0, self.v.id.get, self.v.byte_id
        while at < n:
            symbol = s[at : end[at]]
            i = id_of(symbol)
            if i is None:
                ids += [byte_id[b] for b in symbol.encode()]
            else:
                ids.append(i)
            at = end[at]
        return ids

    def _merge_rows(self, segments: list[str], width: int) -> list[bytes]:
        """:meth:`merge` for segments of known characters, at most ``width`` each, a row of arrays for each."""
        v, rows, shift = self.v, len(segments), width.bit_length()
        nothing = 1 << 50
        n = np.array([len(s) for s in segments])
        places = np.arange(width)
        inside = places < n[:, None]
        symbol = np.full((rows, width + 1), -1, np.int64)
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        symbol[:, :-1][inside] = v.code_ids[np.searchsorted(v.codes, codes)]
        agenda = np.full((rows, width), nothing, np.int64)
        makes = np.full((rows, width), -1, np.int64)

        def enter(row, at, left, right):
            keys = left << 32 | right
            pair = np.minimum(np.searchsorted(v.pairs, keys), len(v.pairs) - 1)
            found = (v.pairs[pair] == keys) & (left >= 0) & (right >= 0)
            agenda[row, at] = np.where(found, v.pair_rank[pair] << shift | at, nothing)
            makes[row, at] = v.pair_makes[pair]

        row, at = np.nonzero(inside[:, 1:])
        enter(row, at, symbol[row, at], symbol[row, at + 1])
        end = np.tile(np.arange(1, width + 2), (rows, 1))
        before = np.tile(np.arange(-1, width), (rows, 1))
        live = inside.copy()
        row = np.arange(rows)
        while True:
            first = agenda[row].min(axis=1)
            row = row[first < nothing]
            if not len(row):
                break
            at = first[first < nothing] & ((1 << shift) - 1)
            middle = end[row, at]
            stop = end[row, middle]
            symbol[row, at], end[row, at], before[row, stop] = makes[row, at], stop, at
            live[row, middle] = False
            agenda[row, middle] = nothing
            right = np.where(stop < n[row], symbol[row, stop], -1)
            enter(row, at, symbol[row, at], right)
            left = before[row, at]
            has = left >= 0
            enter(row[has], left[has], symbol[row[has], left[has]], symbol[row[has], at[has]])
        ids = symbol[:, :-1][live].astype(np.int32).tobytes()
        cuts = [0, *(4 * np.cumsum(live.sum(axis=1))).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _merged(self, segments: list[str]) -> list[bytes]:
        out = [b""] * len(segments)
        short = np.fromiter(map(len, segments), np.int64, len(segments))
        short[short >= LONG] = 0
        short *= np.fromiter(map(self.v.single.issuperset, segments), bool, len(segments))
        for i in np.flatnonzero(short == 0).tolist():
            out[i] = self._segment(segments[i])
        width = 1
        while width < 2 * LONG:
            places = np.flatnonzero((short > width // 2) & (short <= width)).tolist()
            for start in range(0, len(places), ROWS):
                part = places[start : start + ROWS]
                for i, ids in zip(part, self._merge_rows([segments[i] for i in part], width)):
                    out[i] = ids
            width *= 2
        return out

    def _segment(self, s: str) -> bytes:
        if len(s) < LONG:
            return array("i", self.merge(s)).tobytes()
        joined, out, start = self.v.joined, [], 0
        for i in range(1, len(s)):
            if s[i - 1 : i + 1] not in joined:
                out.append(array("i", self.merge(s[start:i])).tobytes())
                start = i
        return b"".join([*out, array("i", self.merge(s[start:])).tobytes()])

    def _trim(self) -> None:
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0

    def _learn(self, segments: set[str]) -> None:
        new = list(segments - self.known.keys())
        ids = self._merged(new)
        self.known.update(zip(new, ids))
        self.held += _ENTRY * len(new) + 2 * sum(map(len, new)) + sum(map(len, ids))

    def encode_column(self, column: pa.Array) -> pa.Array:
        """:meth:`encode` for a string column, as a list column.

        Arrow puts a mark before every border and finds the different segments; Python sees each of these once.
        """
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.v.cut_at_spaces or pc.any(pc.match_substring(texts, MARK)).as_py():
            return _lists(self.encode(texts.to_pylist()))
        self._trim()
        n = len(texts)
        sign, nothing = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
        signed = pc.binary_join_element_wise(sign, pc.replace_substring(texts, " ", SPACE), nothing)
        signed = pc.if_else(pc.equal(pc.binary_length(texts), 0), nothing, signed)
        marked = pc.replace_substring(signed, SPACE, MARK + SPACE)
        inner = SPACE + MARK + SPACE
        while pc.any(pc.match_substring(marked, inner)).as_py():  # a run has one mark; each turn halves the rest
            marked = pc.replace_substring(marked, inner, SPACE + SPACE)
        if self.lines:
            marked = pc.replace_substring(marked, "\n", f"{MARK}\n{MARK}")
        parts = pc.split_pattern(marked, MARK)
        words = parts.flatten().dictionary_encode()
        unique = words.dictionary.to_pylist()
        self._learn(set(unique) - {""})
        known = self.known
        found = [known[s] if s else b"" for s in unique]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        which = words.indices.to_numpy(zero_copy_only=False)
        size = sizes[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = np.frombuffer(b"".join(found), np.int32)[np.arange(ends[-1]) + np.repeat(starts[which] - ends[:-1], size)]
        # Per text its ids, then the end id.
        bounds = ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        out = np.empty(len(ids) + n, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
        out[bounds[1:] + np.arange(n)] = self.v.end_id
        return pa.ListArray.from_arrays(pa.array((bounds + np.arange(n + 1)).astype(np.int32)), pa.array(out))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id, as the bytes of int32 numbers; null counts as empty."""
        self._trim()
        known, ending = self.known, array("i", [self.v.end_id]).tobytes()
        cut = [self.split(SPACE + t.replace(" ", SPACE)) if t else () for t in texts]
        self._learn(set().union(*cut))
        return [b"".join([*map(known.__getitem__, parts), ending]) for parts in cut]


class Decoder:
    """Bytes of ids, from one buffer of all pieces."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        table = [
            bytes([int(t[3:5], 16)]) if kind == _BYTE
            else b"" if kind == _CONTROL
            else " ⁇ ".encode() if kind == _UNKNOWN
            else t.replace(SPACE, " ").encode()
            for t, kind in zip(v.text, v.kind)
        ]
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.size = np.array([len(t) for t in table])
        self.start = np.cumsum(self.size) - self.size
        self.kind = np.array(v.kind)
        self.spaced = np.array([kind == _NORMAL and t.startswith(SPACE) for t, kind in zip(v.text, v.kind)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text: control ids give nothing, the sign in front goes, bytes that form no character
        give one U+FFFD each."""
        kind = self.kind[ids]
        shown = ids[kind != _CONTROL]
        if not len(shown):
            return b""
        size = self.size[shown]
        ends = np.cumsum(size)
        data = self.bytes[np.arange(size.sum()) + np.repeat(self.start[shown] - ends + size, size)].tobytes()
        if (kind == _BYTE).any():
            # Bytes on two sides of a control id form no character.
            cuts = np.concatenate([[0], ends])[np.cumsum(kind != _CONTROL)[kind == _CONTROL]]
            bounds = [0, *cuts.tolist(), len(data)]
            data = b"".join(data[a:b].decode("utf-8", "musterline_each_byte").encode() for a, b in zip(bounds, bounds[1:]))
        return data[1:] if self.spaced[shown[0]] else data


def load_vocabulary(path: str) -> Vocabulary:
    """The model file, read on the driver: some hundred KB."""
    with open(path, "rb") as file:
        return Vocabulary(file.read())


_workers: dict[bytes, tuple] = {}


def _worker(model: bytes) -> tuple:
    """Encoder, decoder and the library's processor, once per Python worker and model."""
    if model not in _workers:
        import sentencepiece

        v = Vocabulary(model)
        _workers.clear()
        _workers[model] = Encoder(v), Decoder(v), sentencepiece.SentencePieceProcessor(model_proto=model)
    return _workers[model]


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode_pieces(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>) of each whole text and the end id.

    A null text counts as empty and has the end id only. Repeated rows are encoded alike. A very long text
    without a border takes some 80 bytes a character while it is encoded. All columns stay; one that is
    already called ``ids`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.model)
    kept = docs.drop(ids)

    def encoded(batches):
        encoder = _worker(sent.value)[0]
        for part in slices(batches, text, size=2 << 20):
            column = encoder.encode_column(part.column(text))
            yield pa.record_batch([*part.columns, column], names=[*part.schema.names, ids])

    return kept.mapInArrow(encoded, with_fields(kept.schema, f"`{ids}` array<int>"))


def decode_pieces(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids as UTF-8 bytes in ``decoded``; null ids are an empty text.

    All columns stay; one that is already called ``decoded`` is replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(vocabulary.model)
    kept = df.drop(decoded)

    def decoding(batches):
        decoder = _worker(sent.value)[1]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = pc.fill_null(part.column(ids), pa.scalar([], part.column(ids).type))
                bounds = lists.offsets.to_numpy()
                flat = lists.values.to_numpy(zero_copy_only=False)
                texts = [decoder.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, decoded])

    return kept.mapInArrow(decoding, with_fields(kept.schema, f"`{decoded}` binary"))


def encoded_and_checked(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``decoded`` (binary) and ``agrees``: both equal the library's result.

    Null, empty, long and repeated texts as in :func:`encode_pieces`. Columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.model)
    kept = docs.drop("ids", "decoded", "agrees")

    def both(batches):
        encoder, decoder, library = _worker(sent.value)
        for part in slices(batches, text, size=2 << 20):
            found = encoder.encode_column(part.column(text))
            ids, bounds = found.values.to_numpy(), found.offsets.to_numpy()
            decoded = [decoder.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            texts = [t or "" for t in part.column(text).to_pylist()]
            theirs = library.encode(texts, add_bos=False, add_eos=True, num_threads=1)
            shown = library.decode(theirs, num_threads=1)
            agrees = [
                array("i", x).tobytes() == ids[a:b].tobytes() and y.encode() == z
                for x, a, b, y, z in zip(theirs, bounds, bounds[1:], shown, decoded)
            ]
            yield pa.record_batch(
                [*part.columns, found, pa.array(decoded, pa.binary()), pa.array(agrees, pa.bool_())],
                names=[*part.schema.names, "ids", "decoded", "agrees"],
            )

    return kept.mapInArrow(both, with_fields(kept.schema, "ids array<int>, decoded binary, agrees boolean"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded texts of all documents; ``agrees`` compares with the library."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = encoded_and_checked(docs, load_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees",
    )
