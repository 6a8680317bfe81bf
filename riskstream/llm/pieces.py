"""SentencePiece BPE encoding and decoding, by vectorised merge rounds.

A text is cut where no piece of the vocabulary can reach across: before every space, and between two
characters that stand side by side in no piece. The resulting words lie in flat numpy arrays. Each
round looks up the rank of all adjacent pairs, takes every word's lowest rank, merges it at its
leftmost place (at all its places, left to right, when no piece that contains the merged one ranks
as low, so that no other merge can come between), and compacts the arrays, until no pair remains.
Words longer than ``LONG_WORD`` symbols, which would need as many rounds, take the same merges from
a priority queue.

The model file must be BPE with identity normalisation, a dummy prefix, byte fallback and white
space kept; any other kind is refused.

Defined results: null counts as the empty text, which has only the begin and end ids. Repeated rows
are encoded one by one. Texts are read whole, whatever their length. An empty table gives no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from riskstream.llm import storage

SPACE = "▁"
LONG_WORD = 256
#: Words whose ids a worker remembers.
CACHE_WORDS = 100_000
_NO_RANK = np.int64(1) << 40
_LATIN = "A-Za-zÀ-ɏ"
_WORD = re.compile(f"[{_LATIN}]")
_SPACED_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_PLAIN_UNITS = re.compile(f"{SPACE}*[{_LATIN}]+|{SPACE}*[^{_LATIN}{SPACE}]+|{SPACE}+")


class PieceModel:
    """The vocabulary of a model file as lookup arrays."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        kinds = {piece.type for piece in proto.pieces}
        if (
            proto.trainer_spec.model_type != 2
            or norm.precompiled_charsmap
            or not norm.add_dummy_prefix
            or norm.remove_extra_whitespaces
            or not proto.trainer_spec.byte_fallback
            or kinds - {1, 2, 3, 6}
        ):
            raise ValueError("not a BPE model with byte fallback, identity normalisation and a dummy prefix")
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = library.bos_id(), library.eos_id()
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        score = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.byte_ids = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.surface = [p.piece.replace(SPACE, " ").encode() if p.type == 1 else b"" for p in proto.pieces]
        for value, place in enumerate(self.byte_ids.tolist()):
            self.surface[place] = bytes([value])
        self.surface[library.unk_id()] = proto.trainer_spec.unk_surface.encode()
        order = {value: rank for rank, value in enumerate(sorted(set(score.values()), reverse=True))}
        self.size = len(proto.pieces)
        self.rank = np.full(self.size, _NO_RANK)
        for piece, place in self.ids.items():
            self.rank[place] = order[score[piece]]
        # every way to put a piece together from two pieces
        pairs = {}
        busy = set()  # pieces inside another that ranks as low: their merges may be interrupted
        for piece, place in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = place
            for a in range(len(piece)):
                for b in range(a + 1, len(piece) + 1):
                    part = self.ids.get(piece[a:b])
                    if part is not None and part != place and self.rank[part] >= self.rank[place]:
                        busy.add(part)
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_piece = np.array([pairs[key] for key in self.pair_keys.tolist()], dtype=np.int64)
        self.calm = np.ones(self.size, dtype=bool)
        self.calm[list(busy)] = False
        self._characters(pairs)
        self.units = _PLAIN_UNITS if self._words_apart() else _SPACED_UNITS
        self.cache: dict[str, bytes] = {}

    def _characters(self, pairs: dict[int, int]) -> None:
        """Single characters get dense numbers, so that what two of them make is a table lookup."""
        singles = [piece for piece in self.ids if len(piece) == 1]
        if set("".join(self.ids)) - set(singles):
            raise ValueError("a piece holds a character that is no piece")
        number = {character: k + 1 for k, character in enumerate(singles)}  # 0: not in the vocabulary
        self.character_id = np.array([-1, *(self.ids[c] for c in singles)], dtype=np.int64)
        self.low_number = np.zeros(0x10000, dtype=np.int32)
        high = {}
        for character, k in number.items():
            if ord(character) < 0x10000:
                self.low_number[ord(character)] = k
            else:
                high[ord(character)] = k
        self.high_codes = np.array([*sorted(high), 0x7FFFFFFF], dtype=np.int64)
        self.high_number = np.array([*(high[code] for code in sorted(high)), 0], dtype=np.int32)
        width = len(singles) + 1
        self.side_by_side = np.zeros((width, width), dtype=bool)
        self.first_pair = np.full((width, width), -1, dtype=np.int32)
        for piece in self.ids:
            for a, b in zip(piece, piece[1:], strict=False):
                self.side_by_side[number[a], number[b]] = True
        for a, k in number.items():
            row = self.ids[a] * self.size
            for b in np.flatnonzero(self.side_by_side[k]).tolist():
                self.first_pair[k, b] = pairs.get(row + int(self.character_id[b]), -1)

    def _words_apart(self) -> bool:
        """Whether no piece reaches from a Latin letter to another visible character or back."""
        return not any(
            SPACE not in (a, b) and bool(_WORD.match(a)) != bool(_WORD.match(b))
            for piece in self.ids
            for a, b in zip(piece, piece[1:], strict=False)
        )

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The dense number of each code point."""
        result = self.low_number[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        if len(high):
            place = np.searchsorted(self.high_codes, codes[high])
            result[high] = np.where(self.high_codes[place] == codes[high], self.high_number[place], 0)
        return result

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left * self.size + right
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_keys[place] == key), self.pair_piece[place], -1)


def merge_rounds(
    model: PieceModel, symbols: np.ndarray, pair: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Merge flat symbols, word by word, until no pair remains; returns symbols and word bounds.

    ``pair`` holds what each symbol makes with the next one of its word, or -1.
    """
    n_words = len(bounds) - 1
    word = np.repeat(np.arange(n_words), np.diff(bounds))
    done_symbols, done_words = [], []
    while True:
        rank = np.where(pair >= 0, model.rank[pair], _NO_RANK)
        head = np.ones(len(word), dtype=bool)
        head[1:] = word[1:] != word[:-1]
        first = np.flatnonzero(head)
        best = np.minimum.reduceat(rank, first) if len(first) else np.zeros(0, dtype=np.int64)
        live = best < _NO_RANK
        lengths = np.diff(np.append(first, len(symbols)))
        if not live.all():
            keep = np.repeat(live, lengths)
            done_symbols.append(symbols[~keep])
            done_words.append(word[~keep])
            symbols, word, pair, rank, lengths = symbols[keep], word[keep], pair[keep], rank[keep], lengths[live]
        if not len(symbols):
            break
        at = np.flatnonzero(rank == np.repeat(best[live], lengths))
        # leftmost of each word; further ones where the piece is calm and the places do not overlap
        leading = np.ones(len(at), dtype=bool)
        leading[1:] = word[at[1:]] != word[at[:-1]]
        linked = np.zeros(len(at), dtype=bool)
        linked[1:] = (at[1:] == at[:-1] + 1) & ~leading[1:]
        streak = np.arange(len(at)) - np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
        at = at[leading | (model.calm[pair[at]] & (streak % 2 == 0))]
        symbols[at] = pair[at]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        symbols, word, pair = symbols[stay], word[stay], pair[stay]
        # only the pairs on either side of a merged symbol are new
        merged = at - np.arange(len(at))
        fresh = np.zeros(len(symbols), dtype=bool)
        fresh[merged] = True
        fresh[np.maximum(merged - 1, 0)] = True
        stale = np.flatnonzero(fresh)
        next_one = np.minimum(stale + 1, len(symbols) - 1)
        same = (stale + 1 < len(symbols)) & (word[stale] == word[next_one])
        pair[stale] = np.where(same, model.merged(symbols[stale], symbols[next_one]), -1)
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.searchsorted(word[order], np.arange(n_words + 1))


def merge_queue(model: PieceModel, symbols: list[int]) -> list[int]:
    """The same merges for one long word: lowest rank first, then leftmost."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbol = list(symbols)
    lookup = dict(zip(model.pair_keys.tolist(), model.pair_piece.tolist(), strict=True))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and symbol[i] >= 0 and symbol[j] >= 0:
            piece = lookup.get(symbol[i] * model.size + symbol[j])
            if piece is not None:
                heapq.heappush(heap, (int(model.rank[piece]), i, symbol[i], symbol[j]))

    for i in range(n - 1):
        offer(i)
    gone = [False] * n
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i] if not gone[i] else n
        if j >= n or symbol[i] != left or symbol[j] != right:
            continue
        symbol[i] = lookup[left * model.size + right]
        gone[j] = True
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [symbol[i] for i in range(n) if not gone[i]]


def encode_words(model: PieceModel, units: list[str]) -> list[bytes]:
    """The ids of each word as little-endian 32-bit integers."""
    text = "".join(units)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    number = model.numbers(codes)
    symbols = model.character_id[number]
    unit_end = np.cumsum(np.fromiter(map(len, units), dtype=np.int64, count=len(units)))
    pair = np.full(len(symbols), -1, dtype=np.int64)
    pair[:-1] = model.first_pair[number[:-1], number[1:]]
    pair[unit_end - 1] = -1
    cut = np.ones(len(symbols), dtype=bool)
    cut[:-1] = ~model.side_by_side[number[:-1], number[1:]]
    cut[unit_end - 1] = True
    bounds = np.concatenate([[0], np.flatnonzero(cut) + 1])
    size = np.diff(bounds)
    out = [b""] * len(units)
    pieces: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    short = size <= LONG_WORD
    member = np.repeat(short, size)
    merged, first = merge_rounds(
        model, symbols[member], pair[member], np.concatenate([[0], np.cumsum(size[short])])
    )
    pieces.append(merged)
    owners.append(np.repeat(np.flatnonzero(short), np.diff(first)))
    for k in np.flatnonzero(~short):
        found = np.array(merge_queue(model, symbols[bounds[k] : bounds[k + 1]].tolist()), dtype=np.int64)
        pieces.append(found)
        owners.append(np.full(len(found), k))
    piece, owner = np.concatenate(pieces), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    piece, owner = piece[order], owner[order]
    # a character outside the vocabulary is a segment of its own, as no piece holds it
    unknown = np.flatnonzero(piece < 0)
    if len(unknown):
        raw = [text[at].encode() for at in bounds[owner[unknown]].tolist()]
        width = np.ones(len(piece), dtype=np.int64)
        width[unknown] = [len(value) for value in raw]
        strange = np.repeat(piece < 0, width)
        piece, owner = np.repeat(piece, width), np.repeat(owner, width)
        piece[strange] = model.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    unit_of = np.searchsorted(unit_end, bounds[owner], side="right")
    edges = np.searchsorted(unit_of, np.arange(len(units) + 1))
    flat = piece.astype("<u4").tobytes()
    for k in range(len(units)):
        out[k] = flat[4 * edges[k] : 4 * edges[k + 1]]
    return out


def encode(model: PieceModel, texts: Iterable[str | None]) -> list[bytes]:
    """The ids of each text, begin and end ids included, as little-endian 32-bit integers."""
    begin, end = np.array([model.bos], "<u4").tobytes(), np.array([model.eos], "<u4").tobytes()
    split = []
    fresh: set[str] = set()
    cache = model.cache
    if len(cache) > CACHE_WORDS:
        cache.clear()
    for text in texts:
        units = model.units.findall(SPACE + text.replace(" ", SPACE)) if text else []
        split.append(units)
        fresh.update(set(units).difference(cache))
    if fresh:
        words = list(fresh)
        cache.update(zip(words, encode_words(model, words), strict=True))
    return [b"".join([begin, *map(cache.__getitem__, units), end]) for units in split]


def decode(model: PieceModel, ids: bytes) -> str:
    """The text of little-endian 32-bit ids; control ids are silent, the dummy prefix is dropped."""
    raw = b"".join(map(model.surface.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
    text = raw.decode("utf-8", errors="replace")
    return text[1:] if text.startswith(" ") else text


_LOADED: dict[str, PieceModel] = {}


def _model(name: str) -> PieceModel:
    path = SparkFiles.get(name)
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def model_file(name: str = "piece_bpe_32k.model") -> str:
    """Where the installed vocabulary package keeps a model file."""
    import public_tokenizers

    return public_tokenizers.path(name)


BATCH_CHARS = 1 << 18


def _grouped(texts: Iterable[str | None]) -> Iterable[list[str | None]]:
    group: list[str | None] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def with_ids(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """The key, ``ids`` (array of int, begin and end ids included) and ``decoded`` of every row."""
    return _mapped(docs, model_path, key, digests=False)


def with_digests(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """The key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row."""
    return _mapped(docs, model_path, key, digests=True)


def with_tokens(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """The key, ``ids`` as in :func:`with_ids`, and the digests, of every row."""
    return _mapped(docs, model_path, key, digests=True, ids_too=True)


def _mapped(docs: DataFrame, model_path: str, key: str, digests: bool, ids_too: bool = False) -> DataFrame:
    docs.sparkSession.sparkContext.addFile(model_path)
    name = model_path.rsplit("/", 1)[-1]

    def run(batches):
        model = _model(name)
        for batch in batches:
            at = 0
            for texts in _grouped(text.as_py() for text in batch.column(1)):
                ids = encode(model, texts)
                decoded = [decode(model, row) for row in ids]
                own = batch.column(0).slice(at, len(texts))
                at += len(texts)
                arrays = [np.frombuffer(row, dtype="<u4").astype(np.int32) for row in ids] if ids_too or not digests else []
                edges = pa.array(np.cumsum([0, *map(len, arrays)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(arrays))) if arrays else None
                if digests:
                    columns = [lists] if ids_too else []
                    columns += [
                        pa.array([len(row) // 4 for row in ids], pa.int64()),
                        pa.array([hashlib.sha256(row).hexdigest() for row in ids]),
                        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in decoded]),
                    ]
                    names = [key, *(["ids"] if ids_too else []), "n_tokens", "ids_sha256", "decoded_sha256"]
                    yield pa.RecordBatch.from_arrays([own, *columns], names=names)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [own, lists, pa.array(decoded)], names=[key, "ids", "decoded"]
                    )

    kind = docs.schema[key].dataType.simpleString()
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    result = f"ids array<int>, {result}" if ids_too else result
    return storage.texts(docs).select(key, "text").mapInArrow(run, f"`{key}` {kind}, {result}")
