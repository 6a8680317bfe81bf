"""Licence scan: MinHash bands over overlapping text windows find templates, shingle containment decides.

Texts and templates become sequences of five-word shingles. Each template has a window length, the largest
power of two such that windows at half that distance fit into it whole. Windows of a text and all windows of
the templates get MinHash signatures in bands; a window that holds no shingle of any template shares
nothing with one and is passed over. With ``BANDS`` bands of ``ROWS`` a window half alike is found with
probability 1 - (1 - 0.5 ** ROWS) ** BANDS, over 0.998; an exact copy always is. A template found in a window
is verified around it: the share of its distinct shingles within its own length on either side must reach
``CONTAINMENT``.

Where one stretch verifies several templates, all of them are returned; copies of one template in a text are
separate matches. Defined results: null or a text of fewer than five words matches nothing. Texts of any
length are scanned whole. Repeated rows are scanned one by one. An empty table gives no rows. Columns other
than the two named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskstream.llm import storage
from riskstream.llm.license_templates import TEMPLATES
from riskstream.llm.textarrays import (
    ALPHANUMERIC,
    LOWER,
    Chunk,
    chunks,
    hashes,
    mix,
    runs,
    starts_within,
    words,
)

SHINGLE = 5
BANDS, ROWS = 24, 2
CONTAINMENT = 0.8
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def band_hashes(windows: np.ndarray) -> np.ndarray:
    """Band hashes of windows (one per row of shingle hashes): one column per band."""
    result = np.empty((len(windows), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        total = np.full(len(windows), np.uint64(band + 1))
        for row in range(ROWS):
            total = mix(total ^ (windows * _FACTORS[band * ROWS + row]).min(axis=1))
        result[:, band] = total
    return result


def _shingled(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk, and per row the first shingle and the end."""
    low = Chunk(chunk.first, LOWER[chunk.data], chunk.offsets)
    found = words(low, ALPHANUMERIC)
    value = runs(hashes(low.data, found.start, found.end), SHINGLE)
    at = starts_within(found.row_first, SHINGLE)
    bounds = np.searchsorted(at, found.row_first)
    return value[at], bounds[:-1], bounds[1:]


class Index:
    """Templates as shingle sets, and band hashes of their windows per window length."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.names = [name for name, _ in templates]
        self.sets: list[np.ndarray] = []
        self.lengths: list[int] = []
        tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (_, text) in enumerate(templates):
            (chunk,) = chunks(pa.array([text]), 1 << 30)
            value, _, _ = _shingled(chunk)
            if not len(value):
                raise ValueError(f"a template needs {SHINGLE} words: {text!r}")
            size = 1
            while 2 * size + size - 1 <= len(value):
                size *= 2
            self.sets.append(np.unique(value))
            self.lengths.append(len(value))
            windows = np.lib.stride_tricks.sliding_window_view(value, size)
            tables.setdefault(size, []).append((band_hashes(windows), np.full(len(windows), k)))
        self.known = np.unique(np.concatenate(self.sets))
        self.bands: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, parts in tables.items():
            owner = np.concatenate([p[1] for p in parts])
            per_band = []
            for band in range(BANDS):
                value = np.concatenate([p[0][:, band] for p in parts])
                order = np.argsort(value, kind="stable")
                per_band.append((value[order], owner[order]))
            self.bands[size] = per_band

    def candidates(self, value: np.ndarray, first: np.ndarray, last: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Distinct (start of window, length, template) found by a shared band hash."""
        found = [np.zeros((0, 3), dtype=np.int64)]
        row = np.searchsorted(first, hits, side="right") - 1
        begin, end = first[row], last[row]
        for size, per_band in self.bands.items():
            stride = max(1, size // 2)
            starts = [begin + (hits - begin) // stride * stride - back * stride for back in range(-(-size // stride))]
            # the last window of a row ends with it
            start = np.minimum(np.concatenate(starts), np.tile(end - size, len(starts)))
            low, hit = np.tile(begin, len(starts)), np.tile(hits, len(starts))
            start = np.unique(start[(start >= low) & (start <= hit) & (start + size > hit)])
            if not len(start):
                continue
            signature = band_hashes(value[start[:, None] + np.arange(size)])
            for band, (known, owner) in enumerate(per_band):
                left = np.searchsorted(known, signature[:, band], side="left")
                count = np.searchsorted(known, signature[:, band], side="right") - left
                entry = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found.append(np.stack([np.repeat(start, count), np.full(len(entry), size), owner[entry]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def _stretch(self, value: np.ndarray, near: np.ndarray, template: int) -> tuple[int, int, float]:
        """First and last shingle of the first stretch that holds enough of the template, and its share.

        ``near`` are the places of the template's shingles; a stretch is at most a quarter longer than it.
        """
        need, total = CONTAINMENT * len(self.sets[template]), len(self.sets[template])
        limit = self.lengths[template] + -(-self.lengths[template] // 4)
        stops = np.searchsorted(near, near + limit)
        for low, stop in enumerate(stops.tolist()):
            if stop - low < need:
                continue
            _, fresh = np.unique(value[near[low:stop]], return_index=True)
            if len(fresh) >= need:
                last = low + int(fresh.max())
                _, again = np.unique(value[near[low : last + 1]][::-1], return_index=True)
                return int(near[last - int(again.max())]), int(near[last]), len(fresh) / total
        return 0, 0, 0.0

    def matches(self, chunk: Chunk) -> list[list[tuple[str, int, int, float]]]:
        """Per row: licence, first word, end word, containment of each match, in order."""
        value, first, last = _shingled(chunk)
        result: list[list[tuple[str, int, int, float]]] = [[] for _ in range(chunk.rows)]
        place = np.minimum(np.searchsorted(self.known, value), len(self.known) - 1)
        hits = np.flatnonzero(self.known[place] == value)
        if not len(hits):
            return result
        done: dict[tuple[int, int], int] = {}
        for start, size, template in self.candidates(value, first, last, hits).tolist():
            row = int(np.searchsorted(first, start, side="right")) - 1
            if done.get((row, template), -1) >= start:
                continue  # within a match of the same template
            reach = self.lengths[template]
            low = max(int(first[row]), start - reach, done.get((row, template), -1) + 1)
            high = min(int(last[row]), start + size + reach)
            near = hits[np.searchsorted(hits, low) : np.searchsorted(hits, high)]
            near = near[np.isin(value[near], self.sets[template])]
            begin, end, share = self._stretch(value, near, template)
            if share >= CONTAINMENT:
                origin = int(first[row])
                result[row].append((self.names[template], begin - origin, end - origin + SHINGLE, share))
                done[row, template] = end
        for row in result:
            row.sort(key=lambda match: (match[1], match[2], match[0]))
        return result


_MATCH = pa.struct(
    [("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]
)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id and ``matches`` (array of licence, start and end word, containment) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates))

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = [
                    [dict(zip(("license", "start", "end", "containment"), match, strict=True)) for match in row]
                    for row in shared.value.matches(chunk)
                ]
                own = batch.column(0).slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays([own, pa.array(found, pa.list_(_MATCH))], names=["doc_id", "matches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return storage.texts(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, matches array<struct<license:string,start:bigint,end:bigint,containment:double>>"
    )
