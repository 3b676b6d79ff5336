"""SentencePiece BPE with byte fallback by vectorised merge rounds.

A text is cut into segments that no piece can span; each distinct segment is
merged once. All segments of a block lie in one flat array of symbols. In each
round every segment finds its best pair by a segmented minimum of ranks and
merges it, all segments at once; finished segments leave the array. Where a
merge could open a better pair, or ranks tie, a segment merges only its leftmost
pair in that round, so that the result is that of the library's queue; a very long
segment of that kind (a run of spaces, say) is finished by a queue.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import blocks, large_texts

NORMAL, UNKNOWN, BYTE = 1, 2, 6  # fixed values of the model format
SPACE = "▁"
# Texts that need more than cuts at single spaces and line ends.
ODD = "^ |  |\\x00|" + SPACE
NO_PAIR = np.iinfo(np.int32).max
CACHED_SEGMENTS = 400_000
ENCODED_BYTES = 3 << 20  # text encoded at once; its ids take many times that
QUEUED_SYMBOLS = 256
MERGED = 30_000

ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class PieceModel:
    """Tables of a model file: identity normaliser, dummy prefix, byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if (
            rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not rules.add_dummy_prefix
            or not proto.trainer_spec.byte_fallback
            or proto.trainer_spec.model_type != 2
        ):
            raise ValueError("only BPE with byte fallback and an identity normaliser")
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        symbols = dict(normal)
        for piece in normal:
            for char in piece:
                symbols.setdefault(char, len(proto.pieces) + len(symbols))
        self.n_pieces = len(proto.pieces)
        self.n_symbols = max(symbols.values()) + 1
        scores = np.full(self.n_symbols, -np.inf)
        for piece, i in normal.items():
            scores[i] = proto.pieces[i].score
        levels, ranks = np.unique(-scores, return_inverse=True)
        tied = np.bincount(ranks, minlength=len(levels))[ranks] > 1

        lefts, rights, merged = [], [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    lefts.append(left)
                    rights.append(right)
                    merged.append(i)
        left, right, whole = (np.array(x, np.int64) for x in (lefts, rights, merged))
        keys = left * self.n_symbols + right
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], whole[order]
        self.ranks = ranks[self.merged].astype(np.int32)
        early = tied.copy()
        early[left[ranks[whole] <= ranks[left]]] = True
        early[right[ranks[whole] <= ranks[right]]] = True
        self.leftmost_only = early
        self.pair: dict[int, tuple[int, int]] = {}

        self.symbol_of_char = np.arange(0x110000, dtype=np.int64) + self.n_symbols
        for symbol, i in symbols.items():
            if len(symbol) == 1:
                self.symbol_of_char[ord(symbol)] = i
        self.decimal = list(map(str, range(self.n_pieces)))
        self.char_of_symbol = np.zeros(self.n_symbols, np.int64)
        for symbol, i in symbols.items():
            if i >= self.n_pieces:
                self.char_of_symbol[i] = ord(symbol)
        self.byte_id = np.zeros(256, np.int64)
        self.is_byte = np.zeros(self.n_pieces, bool)
        decoded: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
                self.is_byte[i] = True
                decoded.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == NORMAL:
                decoded.append(p.piece.replace(SPACE, " ").encode())
            else:
                decoded.append(" ⁇ ".encode() if p.type == UNKNOWN else b"")
        self.decoded = np.frombuffer(b"".join(decoded), np.uint8)
        self.decoded_len = np.array([len(d) for d in decoded], np.int64)
        self.decoded_start = np.cumsum(self.decoded_len) - self.decoded_len
        # Characters that are in no longer piece stand alone: cuts beside them are safe.
        inner = {c for p in normal if len(p) > 1 for c in p}
        line = "" if "\n" in inner else "\n"
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            self.plain, self.segment = False, re.compile(r".+", re.S)
        else:
            self.plain = bool(line)
            self.segment = re.compile(
                f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (f"|{line}+" if line else "")
            )

    def segments(self, text: str) -> list[str]:
        """Parts of the prefixed text; no piece crosses their borders."""
        if not text:
            return []
        return self.segment.findall(SPACE + text.replace(" ", SPACE))

    def flat_segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Segments of all texts in one array, and where each text's begin and end."""
        texts = large_texts(texts)
        odd = pc.match_substring_regex(texts, ODD) if self.plain else pa.array([True] * len(texts))
        odd = np.asarray(pc.and_(odd, pc.not_equal(texts, "")).to_numpy(zero_copy_only=False))
        plain = texts.filter(pa.array(~odd))
        marked = pc.replace_substring(pc.replace_substring(plain, "\n", "\0\n\0"), " ", "\0" + SPACE)
        marked = pc.binary_join_element_wise(
            pa.array([SPACE] * len(plain), pa.large_string()), marked, pa.scalar("", pa.large_string())
        )
        marked = pc.if_else(pc.equal(plain, ""), pa.scalar("", pa.large_string()), marked)
        split = pc.split_pattern(marked, "\0")
        found = [self.segments(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        counts[~odd] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        counts[odd] = [len(f) for f in found]
        start = np.zeros(len(texts), np.int64)
        for rows, base in ((~odd, 0), (odd, int(counts[~odd].sum()))):
            start[rows] = base + np.cumsum(counts[rows]) - counts[rows]
        flat = pa.concat_arrays(
            [split.flatten(), pa.array([s for f in found for s in f], pa.large_string())]
        )
        return flat, start, start + counts

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.n_symbols + right
        key[(left >= self.n_symbols) | (right >= self.n_symbols)] = -1
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_PAIR), np.where(hit, self.merged[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the number of ids of each."""
        parts = [self._merge(words[i : i + MERGED]) for i in range(0, len(words), MERGED)]
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else self._merge([])

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(words)
        if not text:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        symbol = self.symbol_of_char[chars]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(symbol), NO_PAIR, np.int32)
        whole = np.full(len(symbol), -1, np.int64)
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same], whole[same] = self._pairs(symbol[same], symbol[same + 1])
        done_word, done_symbol = [], []
        while len(symbol):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(word)])
            least = np.minimum.reduceat(rank, start)
            over = np.repeat(least == NO_PAIR, size)
            if over.any():
                done_word.append(word[over])
                done_symbol.append(symbol[over])
                left = ~over
                symbol, word, rank, whole = symbol[left], word[left], rank[left], whole[left]
                live = least != NO_PAIR
                least, size = least[live], size[live]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            run = np.r_[True, np.diff(at) != 1]
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            # One early pair makes its segment go leftmost only.
            early = np.zeros(len(at), bool)
            marked = word[at[self.leftmost_only[whole[at]]]]
            if len(marked):
                mark = np.zeros(len(words), bool)
                mark[marked] = True
                early = mark[word[at]]
                # A long one would need a round for each merge: it goes through a queue.
                long = np.flatnonzero(mark & (np.bincount(word, minlength=len(words)) > QUEUED_SYMBOLS))
                if len(long):
                    for w in long.tolist():
                        rest = self._queued(symbol[word == w].tolist())
                        done_word.append(np.full(len(rest), w))
                        done_symbol.append(np.array(rest, np.int64))
                    left = ~np.isin(word, long)
                    symbol, word, rank, whole = symbol[left], word[left], rank[left], whole[left]
                    continue
            at = at[np.where(early, first, offset % 2 == 0)]
            symbol[at] = whole[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1
            symbol, word, rank, whole = symbol[keep], word[keep], rank[keep], whole[keep]
            changed = np.zeros(len(symbol) + 1, bool)
            changed[new] = changed[new - 1] = True
            touched = np.flatnonzero(changed[:-1])
            rank[touched], whole[touched] = NO_PAIR, -1
            touched = touched[touched < len(word) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], whole[touched] = self._pairs(symbol[touched], symbol[touched + 1])
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        return self._ids(word[order], symbol[order], len(words))

    def _queued(self, symbols: list[int]) -> list[int]:
        """One segment, its best pairs taken from a queue, leftmost first."""
        if not self.pair:
            pairs = zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist()))
            self.pair.update(pairs)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i < 0 or j < 0 or max(symbols[i], symbols[j]) >= self.n_symbols:
                return
            found = self.pair.get(symbols[i] * self.n_symbols + symbols[j])
            if found:
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in symbols if x >= 0]

    def _ids(self, word: np.ndarray, symbol: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary ids; a character without a piece becomes its UTF-8 bytes."""
        lone = symbol >= self.n_pieces
        width = np.ones(len(symbol), np.int64)
        chars = symbol[lone] - self.n_symbols
        inner = chars < 0
        chars[inner] = self.char_of_symbol[symbol[lone][inner]]
        width[lone] = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        ids = np.repeat(symbol, width)
        if lone.any():
            data = "".join(map(chr, chars.tolist())).encode()
            ids[np.repeat(lone, width)] = self.byte_id[np.frombuffer(data, np.uint8)]
        return ids, np.bincount(word, weights=width, minlength=n_words).astype(np.int64)

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, one after the other, and the number of bytes of each id."""
        size = self.decoded_len[ids]
        shift = self.decoded_start[ids] - (np.cumsum(size) - size)
        return self.decoded[np.arange(size.sum()) + np.repeat(shift, size)], size


def text_of_bytes(data: bytes) -> str:
    """Decoded bytes without the dummy prefix; each invalid byte becomes U+FFFD."""
    if data[:1] == b" ":
        data = data[1:]
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for width in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + width].decode())
                    at += width
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


class SegmentCache:
    """Ids of the segments met so far in a task; emptied when full, never cut."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.text: list[str] = []
        self.ids = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def numbers(self, segments: list[str]) -> np.ndarray:
        """The number of each of the distinct ``segments``; new ones are merged."""
        if len(self.index) > CACHED_SEGMENTS:
            self.clear()
        new = [s for s in segments if s not in self.index]
        if new:
            self._add(new)
        return np.fromiter(map(self.index.__getitem__, segments), np.int64, len(segments))

    def _add(self, new: list[str]) -> None:
        ids, size = self.model.merge(new)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        strings = list(map(self.model.decimal.__getitem__, ids.tolist()))
        end = np.cumsum(size).tolist()
        # Each non-empty segment ends in a comma, so that they can be joined as they are.
        self.text += [
            ",".join(strings[a:b]) + "," if b > a else "" for a, b in zip([0, *end], end)
        ]
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(size) - size]
        self.ids, self.size = np.r_[self.ids, ids.astype(np.int32)], np.r_[self.size, size]

    def flat(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the numbered segments, one after the other."""
        size = self.size[numbers]
        shift = self.start[numbers] - (np.cumsum(size) - size)
        return self.ids[np.arange(size.sum()) + np.repeat(shift, size)]


def encoded_blocks(
    batches: Iterable[pa.RecordBatch], model: PieceModel
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], SegmentCache]]:
    """Blocks of rows and, for each row, the numbers of the segments of its text."""
    cache = SegmentCache(model)
    for block in blocks(batches, "text", ENCODED_BYTES):
        flat, start, end = model.flat_segments(block.column("text"))
        coded = flat.dictionary_encode()
        known = cache.numbers(coded.dictionary.to_pylist())
        numbers = known[coded.indices.to_numpy()] if len(flat) else known
        yield block, [numbers[a:b] for a, b in zip(start.tolist(), end.tolist())], cache


def encode_decode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of the ids of every whole text and of the text decoded from them.

    Null and empty texts have no ids and decode to the empty text. One row per
    input row, repeated rows included; a null id stays null. Other columns are
    not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        for block, rows, cache in encoded_blocks(batches, model):
            n_tokens = [int(cache.size[r].sum()) for r in rows]
            strings = cache.text
            hashes = [
                hashlib.sha256("".join([strings[i] for i in r.tolist()])[:-1].encode()).hexdigest()
                for r in rows
            ]
            ids = cache.flat(np.concatenate(rows))
            data, size = model.decode_flat(ids)
            data = data.tobytes()
            token_end = np.cumsum(n_tokens)
            byte_end = np.r_[0, np.cumsum(size)][token_end].tolist()
            decoded = [
                hashlib.sha256(text_of_bytes(data[a:b]).encode()).hexdigest()
                for a, b in zip([0, *byte_end], byte_end)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, ENCODED)


def encode_ids(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and the ``ids`` of every whole text as an array; null is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows, cache in encoded_blocks(batches, PieceModel(model_path)):
            size = [int(cache.size[r].sum()) for r in rows]
            ids = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)),
                pa.array(cache.flat(np.concatenate(rows)), pa.int32()),
            )
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), ids], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null or no ids give the empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                values = np.asarray(ids.as_py() or [], np.int64)
                texts.append(text_of_bytes(model.decode_flat(values)[0].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
