"""Benchmark passages in documents: q-gram lemma over diagonal bands, banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearwell.llm.common import slices

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
FILTER_BITS = 22
WINDOW = 1 << 18
PAIRS_AT_ONCE = 1 << 20


def normal(text: str | None) -> str:
    """Lower case, single spaces."""
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = chars.astype(np.uint64)
    h = wide[:n].copy()
    for i in range(1, q):
        h *= np.uint64(BASE)
        h += wide[i : i + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def edits_by_end(pattern: np.ndarray, region: np.ndarray, most: int) -> np.ndarray | None:
    """Least edits of the whole pattern against a part of the region that ends at 0, 1, ...

    Only the diagonals that let the pattern start anywhere in the region's slack and
    move by ``most`` are computed; values above ``most`` stand as ``most`` + 1, and None
    says that there are no others.
    """
    m, n = len(pattern), len(region)
    low, high = -most, n - m + most  # diagonals j - i
    if high < low:
        return None
    width = high - low + 1
    far = most + 1
    steps = np.arange(width)
    j = low + steps
    row = np.where((j >= 0) & (j <= n), 0, far)  # row 0: starts are free
    padded = np.concatenate([np.zeros(max(0, -low), np.int64) - 1, region.astype(np.int64), np.full(m + width + 2, -1)])
    shift = max(0, -low)
    for i in range(1, m + 1):
        at = low + i - 1 + shift
        letters = padded[at : at + width]  # region[j - 1] for j = i + low + c
        now = row + (letters != pattern[i - 1])
        now[:-1] = np.minimum(now[:-1], row[1:] + 1)
        j = i + low + steps
        now[(j < 0) | (j > n)] = far
        if i + low <= 0 <= i + high:
            now[-(i + low)] = min(i, far)  # nothing of the region used yet
        now = np.minimum.accumulate(now - steps) + steps
        row = np.minimum(now, far)
        if row.min() > most:
            return None
    out = np.full(n + 1, far)
    j = m + low + steps
    inside = (j >= 0) & (j <= n)
    out[j[inside]] = row[inside]
    return out if out.min() <= most else None


def banded_distance(pattern: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int] | None:
    """Least edits of the whole pattern against any part of the region, and where that part ends."""
    ends = edits_by_end(pattern, region, most)
    if ends is None:
        return None
    best = int(ends.argmin())
    return int(ends[best]), best


def letter_counts(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(text, return_counts=True)


def letters_lacking(pattern: tuple[np.ndarray, np.ndarray], text: tuple[np.ndarray, np.ndarray]) -> int:
    """How many letters of the pattern the text has too few of, by their counts; each costs an edit."""
    (letters, wanted), (have, count) = pattern, text
    at = np.minimum(np.searchsorted(have, letters), max(0, len(have) - 1))
    found = np.where(have[at] == letters, count[at], 0) if len(have) else np.zeros(len(letters), np.int64)
    return int(np.maximum(0, wanted - found).sum())


@dataclass(frozen=True)
class PassageIndex:
    """The q-grams of a bounded set of passages.

    ``grams`` is sorted; gram i has the postings ``starts[i]`` to ``starts[i + 1]`` of
    ``items`` and ``places``.  ``least`` is what the q-gram lemma asks of an item:
    length - q + 1 - q * budget shared q-grams.
    """

    q: int
    ids: list
    texts: list[str]
    budgets: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    places: np.ndarray
    short: list[int]

    @classmethod
    def build(cls, rows: list[tuple], q: int, edit_share: float) -> PassageIndex:
        kept = [(i, t) for i, t in ((i, normal(t)) for i, t in rows) if t]
        ids, texts = [i for i, _ in kept], [t for _, t in kept]
        budgets, least, hashes, items, places, short = [], [], [], [], [], []
        for k, text in enumerate(texts):
            m = len(text)
            # as many edits as still leave one q-gram to find the passage by
            budget = max(0, min(int(edit_share * m), (m - q) // q))
            budgets.append(budget)
            least.append(max(1, m - q + 1 - q * budget))
            h = gram_hashes(codes(text), q)
            if not len(h):
                short.append(k)
            hashes.append(h)
            items.append(np.full(len(h), k))
            places.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        return cls(
            q, ids, texts, np.array(budgets, np.int64), np.array(least, np.int64), grams,
            np.append(first, len(h)).astype(np.int64),
            (np.concatenate(items) if items else np.zeros(0, np.int64))[order].astype(np.int64),
            (np.concatenate(places) if places else np.zeros(0, np.int64))[order].astype(np.int64), short,
        )

    def parts(self) -> tuple:
        """The fields: plain values, so that workers can read a broadcast without this package."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def finder(self) -> Finder:
        return Finder(self)


class Finder:
    """Looks for the passages of an index in texts."""

    def __init__(self, index: PassageIndex) -> None:
        self.index = index
        self.hit = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.hit[(index.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.patterns = [codes(t) for t in index.texts]
        self.letters = [letter_counts(p) for p in self.patterns]
        self.reach = max((len(p) + int(b) for p, b in zip(self.patterns, index.budgets, strict=True)), default=0)
        self.short = [(k, re.compile(rf"(?<!\w){re.escape(index.texts[k])}(?!\w)")) for k in index.short]

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of passages in the normalised text; one a place, the best."""
        text = normal(text)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, pattern in self.short:
            for m in pattern.finditer(text):
                found.setdefault(k, []).append((0, m.start(), m.end()))
        step = max(WINDOW, 4 * self.reach)
        for begin in range(0, max(1, len(text) - self.reach), step):
            part = text[begin : begin + step + self.reach] if len(text) > step + self.reach else text
            for k, edits, start, end in self._window(part):
                found.setdefault(k, []).append((edits, begin + start, begin + end))
            if part is text:
                break
        out = []
        for k, spans in found.items():
            kept: list[tuple[int, int, int]] = []
            for span in sorted(set(spans)):
                if all(span[1] >= e or span[2] <= s for _, s, e in kept):
                    kept.append(span)
            out.extend((k, s, e, edits) for edits, s, e in kept)
        return sorted(out)

    def _window(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """Matches in a window.  Nothing it holds exceeds the index and the window in size."""
        index = self.index
        chars = codes(text)
        h = gram_hashes(chars, index.q)
        if not len(h) or not len(index.grams):
            return
        at = np.flatnonzero(self.hit[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return
        rank = np.searchsorted(index.grams, h[at])
        rank[rank == len(index.grams)] = 0
        same = index.grams[rank] == h[at]
        at, rank = at[same], rank[same]
        if not len(at):
            return
        # the places of the passages whose gram the window has, each once
        by_gram = np.argsort(rank, kind="stable")
        at, present = at[by_gram], rank[by_gram]
        first = np.flatnonzero(np.concatenate([[True], present[1:] != present[:-1]]))
        present, stop = present[first], np.append(first[1:], len(at))
        number = index.starts[present + 1] - index.starts[present]
        post = np.repeat(index.starts[present] - np.cumsum(number) + number, number) + np.arange(int(number.sum()))
        item, gram = index.items[post], np.repeat(np.arange(len(present)), number)
        enough = np.bincount(item, minlength=len(index.ids)) >= index.least
        keep = enough[item]
        if not keep.any():
            return
        item, gram, place = item[keep], gram[keep], index.places[post[keep]]
        by_item = np.argsort(item, kind="stable")
        item, gram, place = item[by_item], gram[by_item], place[by_item]
        begins = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        letters = letter_counts(chars)
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(item)], strict=True):
            k = int(item[a])
            if letters_lacking(self.letters[k], letters) <= index.budgets[k]:
                yield from self._regions(text, chars, k, place[a:b], at, first[gram[a:b]], stop[gram[a:b]])

    def _bands(self, k: int, place, at, first, stop, size: int) -> np.ndarray:
        """Bands of diagonals that share enough of the passage's places with the text.

        Edits move a match over at most budget + 1 diagonals; bands are twice as wide and
        overlap by half, so one of them holds the whole match.  A place counts once a
        band, however often its gram stands there.
        """
        wide, m = int(self.index.budgets[k]) + 1, len(self.patterns[k])
        number = stop - first
        total = int(number.sum())
        if total <= PAIRS_AT_ONCE:
            where = at[np.repeat(first - np.cumsum(number) + number, number) + np.arange(total)]
            places = np.repeat(place, number)
            band = (where - places) // wide
            band, places = np.concatenate([band, band - 1]), np.concatenate([places, places])
            low = int(band.min())
            bands, shared = np.unique(np.unique((band - low) * (m + 1) + places) // (m + 1), return_counts=True)
            return bands[shared >= self.index.least[k]] + low
        # the same, a place at a time
        base = -m // wide - 2
        shared = np.zeros(size // wide - base + 3, dtype=np.int32)
        for p, a, b in zip(place.tolist(), first.tolist(), stop.tolist(), strict=True):
            band = (at[a:b] - p) // wide - base
            if len(band) > 1:
                band = band[np.concatenate([[True], band[1:] != band[:-1]])]
                before = band[np.concatenate([[True], band[1:] != band[:-1] + 1])] - 1
            else:
                before = band - 1
            shared[band] += 1
            shared[before] += 1
        return np.flatnonzero(shared >= self.index.least[k]) + base

    def _regions(self, text, chars, k: int, place, at, first, stop) -> Iterator[tuple[int, int, int, int]]:
        """Matches of one passage; bands side by side are verified as one region."""
        wide, m = int(self.index.budgets[k]) + 1, len(self.patterns[k])
        bands = self._bands(k, place, at, first, stop, len(chars))
        if not len(bands):
            return
        breaks = np.flatnonzero(np.diff(bands) > 2)
        for a, b in zip(bands[np.append(0, breaks + 1)].tolist(), bands[np.append(breaks, len(bands) - 1)].tolist(), strict=True):
            low, high = max(0, a * wide), min(len(chars), (b + 2) * wide + m)
            yield from self._verified(text, chars, k, low, high, a == b or (b - a + 2) * wide <= m)

    def _verified(self, text, chars, k: int, low: int, high: int, one: bool) -> Iterator[tuple[int, int, int, int]]:
        """The best matches of a passage in a region that do not overlap; ``one`` place at most, or many."""
        pattern, budget = self.patterns[k], int(self.index.budgets[k])
        m = len(pattern)
        exact = text.find(self.index.texts[k], low, high)
        if exact >= 0 and one:
            yield k, 0, exact, exact + m
            return
        region = chars[low:high]
        if exact < 0 and letters_lacking(self.letters[k], letter_counts(region)) > budget:
            return
        ends = edits_by_end(pattern, region, budget)
        if ends is None:
            return
        covered = np.zeros(len(region), dtype=bool)
        candidates = np.flatnonzero(ends <= budget)
        for end in candidates[np.argsort(ends[candidates], kind="stable")].tolist():
            edits = int(ends[end])
            latest = max(0, end - m + edits)  # the match starts there or before
            if covered[max(0, end - 1)] or covered[min(latest, end - 1)]:
                continue
            start = end - m
            if edits:
                back = banded_distance(pattern[::-1], region[max(0, end - m - budget) : end][::-1], budget)
                start = max(0, end - back[1]) if back else latest
            if not covered[start:end].any():
                covered[start:end] = True
                yield k, edits, low + start, low + end


def passage_parts(
    benchmark: DataFrame, id_col: str, text_col: str, q: int, edit_share: float, index_chars: int
) -> Iterator[PassageIndex]:
    """Indexes over the passages, each of about ``index_chars`` characters at most.

    The size is checked first: what is broadcast never exceeds the bound by more than
    a passage, and a larger benchmark takes several passes over the documents.
    """
    rows = benchmark.where(F.trim(F.coalesce(F.col(text_col), F.lit(""))) != "").select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    size = rows.agg(F.sum(F.length("text")).alias("n")).head()["n"] or 0
    parts = max(1, -(-2 * size // index_chars) if size > index_chars else 1)
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        collected = [(r["id"], r["text"]) for r in own.orderBy("id", "text").collect()]
        if collected:
            yield PassageIndex.build(collected, q, edit_share)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_share: float = 0.1,
    q: int = 8,
    index_chars: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Where benchmark passages stand in documents, up to an edit budget.

    Returns ``id_col``, ``item_col``, ``start``, ``end`` (in the text in lower case
    with single spaces), ``edits``: a row for each place, overlapping places of one
    item merged to the best.  A passage of m characters may differ by ``edit_share``
    of m edits, at most as many as leave one shared q-gram; passages shorter than q
    must stand verbatim between word ends.

    Whole texts are scanned in windows that overlap by the longest passage, in one
    pass without a shuffle.  Null and blank texts and passages match nothing; a
    repeated row or passage is reported each time; empty tables give no rows.
    """
    spark = docs.sparkSession
    kinds = [docs.schema[id_col].dataType, benchmark.schema[item_col].dataType]
    arrow = [to_arrow_type(k) for k in kinds]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = None
    for index in passage_parts(benchmark, item_col, item_text_col, q, edit_share, index_chars):
        shared = spark.sparkContext.broadcast(index.parts())

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = PassageIndex(*shared.value).finder()
            for batch in slices(batches):
                out = []
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    out.extend((doc, finder.index.ids[k], s, e, d) for k, s, e, d in finder.find(text))
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [*arrow, pa.int64(), pa.int64(), pa.int64()], strict=True)],
                    ["id", "item", "start", "end", "edits"],
                )

        schema = f"id {kinds[0].simpleString()}, item {kinds[1].simpleString()}, start long, end long, edits long"
        part = narrow.mapInArrow(scan, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        none = benchmark.select(F.col(item_col).alias("item")).limit(0)
        found = narrow.limit(0).select("id").join(none, F.lit(False))
        found = found.withColumns({c: F.lit(None).cast("long") for c in ("start", "end", "edits")})
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_share: float = 0.1,
    q: int = 8,
    index_chars: int = 4 << 20,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows whose text holds no benchmark passage (as `find_passages` finds them)."""
    at = docs.columns.index(text_col)
    for index in passage_parts(benchmark, item_col, item_text_col, q, edit_share, index_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index.parts())

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = PassageIndex(*shared.value).finder()
            for batch in slices(batches):
                keep = [not finder.find(t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
