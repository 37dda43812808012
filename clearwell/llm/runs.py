"""Periodic runs of words: suffix automaton, last-occurrence paths, squares, runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearwell.llm.common import slices

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def suffix_automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(link, length, state of each prefix) of the suffix automaton of a word sequence.

    Most states have one way out; it is kept in two flat lists, and a dictionary is made
    for a state only when it gets a second one.
    """
    link, length = [-1], [0]
    word_out, to, more = [-1], [-1], {}
    prefixes = []
    last = 0
    for w in words:
        new = len(link)
        length.append(length[last] + 1)
        link.append(0)
        word_out.append(-1)
        to.append(-1)
        p = last
        while p >= 0:
            if word_out[p] == w:
                q = to[p]
                break
            if p in more:
                q = more[p].get(w, -1)
                if q >= 0:
                    break
                more[p][w] = new
            elif word_out[p] < 0:
                word_out[p], to[p] = w, new
            else:
                more[p] = {w: new}
            p = link[p]
        else:
            q = -1
        if q >= 0:
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(link)
                length.append(length[p] + 1)
                link.append(link[q])
                word_out.append(word_out[q])
                to.append(to[q])
                if q in more:
                    more[clone] = dict(more[q])
                while p >= 0:
                    if word_out[p] == w:
                        if to[p] != q:
                            break
                        to[p] = clone
                    elif p in more and more[p].get(w) == q:
                        more[p][w] = clone
                    else:
                        break
                    p = link[p]
                link[q] = link[new] = clone
        prefixes.append(new)
        last = new
    return link, length, prefixes


class LastOccurrences:
    """A rooted tree whose root paths are accessed and coloured one after another.

    `access` gives the path from a node to the root a new colour and returns the
    segments of equal earlier colour that it met, each with its deepest node: the
    access of a link-cut tree.  The tree is known beforehand, so the paths that a
    link-cut tree keeps in balanced trees lie on heavy paths here, where an access always
    recolours an upper part: each heavy path is a stack of segments, the topmost one
    last.  An access meets O(log n) heavy paths and pops what it covers; a new segment
    is pushed once a heavy path, so all accesses together take O(n log n).
    """

    def __init__(self, parent: Sequence[int], depth_key: Sequence[int]) -> None:
        n = len(parent)
        # a parent's key is less than its child's, so this order has parents first
        order = np.argsort(np.asarray(depth_key, dtype=np.int64), kind="stable")
        size = [1] * n
        heavy = [-1] * n
        weight = [0] * n
        for v in order[:0:-1].tolist():
            p = parent[v]
            size[p] += size[v]
            if size[v] > weight[p]:
                weight[p], heavy[p] = size[v], v
        self.parent = parent
        self.head = head = list(range(n))
        self.place = place = [0] * n  # steps below the head of the heavy path
        for v in order.tolist():
            h = heavy[v]
            if h >= 0:
                head[h], place[h] = head[v], place[v] + 1
        self.stacks: dict[int, list[tuple[int, int, int]]] = {}

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """(earlier colour, deepest node on the path) of every segment met, from the node upwards."""
        met: list[tuple[int, int]] = []
        head, place, stacks, parent = self.head, self.place, self.stacks, self.parent
        while node >= 0:
            top, here = head[node], place[node]
            stack = stacks.get(top)
            if stack is None:
                stack = stacks[top] = []
            done, covered = -1, []  # the place down to which segments are covered
            while stack and stack[-1][0] <= here:
                done, deepest, old = stack.pop()
                covered.append((old, deepest))
            if stack and done < here:  # the upper part of a segment that goes on below the node
                covered.append((stack[-1][2], node))
            for segment in reversed(covered):
                if not met or met[-1][0] != segment[0]:  # else it began on the heavy path below
                    met.append(segment)
            stack.append((here, node, colour))
            node = parent[top]
        return met


def automaton_runs(words: Sequence[int], least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of non-negative words.

    After word i the states of the suffixes that end there form the path from the state
    of the prefix to the root of the suffix links.  The path is recoloured with i; a
    segment of earlier colour j with deepest state v says that the longest suffix that
    ends at j and, since then, at no place before i, has length(v) words.  If the
    distance i - j is within that length, the two occurrences touch: a square of period
    i - j ends at i, and with length(v) + i - j words it reaches as far to the left as it
    can.  It is a run if the next word breaks the period; otherwise it is met again at
    the next word.  With an exponent of 3 the distance is the smallest period.
    """
    if exponent < 3:
        raise ValueError("the last occurrence gives the smallest period from three periods on")
    link, length, prefixes = suffix_automaton(words)
    paths = LastOccurrences(link, length)
    out = []
    n = len(words)
    access = paths.access
    for i, state in enumerate(prefixes):
        for j, v in access(state, i):
            q = i - j
            whole = length[v] + q
            if whole >= least and whole >= exponent * q and (i + 1 == n or words[i + 1] != words[i + 1 - q]):
                out.append((i + 1 - whole, whole, q))
    out.sort()
    return out


def repeating_stretches(keys: np.ndarray, least: int = 24, exponent: int = 3) -> list[tuple[int, int]]:
    """[start, stop) stretches outside which no run can lie, from one key a word.

    In a run of length L and period q the first and the last L - q words are the same, and
    L - q is at least ``least`` * (1 - 1 / ``exponent``).  So all words of a run lie in
    grams of that many words (16 at most) that come again at a distance of q, and q is
    at most the run's length over ``exponent``.  Grams whose nearest recurrence is
    farther than that for the stretch they stand in are left out, in a few rounds.
    """
    n = len(keys)
    if n < least:
        return []
    gram, h = 1, keys.astype(np.uint64)
    for m in MULTIPLIERS:
        if 2 * gram > least - least // exponent:
            break
        h = (h[:-gram] * np.uint64(m)) ^ (h[gram:] + (h[gram:] >> np.uint64(29)))
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        gram *= 2
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    if not len(same):
        return []
    near = np.full(len(h), n, dtype=np.int64)
    gap = order[same + 1] - order[same]
    np.minimum.at(near, order[same], gap)
    np.minimum.at(near, order[same + 1], gap)
    at = np.flatnonzero(near <= n // exponent)
    near = near[at]
    for _ in range(8):
        if not len(at):
            return []
        breaks = np.flatnonzero(np.diff(at) > gram)
        first = np.concatenate([[0], breaks + 1])
        last = np.concatenate([breaks, [len(at) - 1]])
        size = np.repeat(at[last] - at[first] + gram, last - first + 1)
        keep = (near * exponent <= size) & (size >= least)
        if keep.all():
            break
        at, near = at[keep], near[keep]
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > gram)
    starts = at[np.concatenate([[0], breaks + 1])]
    stops = at[np.concatenate([breaks, [len(at) - 1]])] + gram
    return list(zip(starts.tolist(), stops.tolist(), strict=True))


def word_runs(words: Sequence[bytes], least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of words, by start, then period.

    `repeating_stretches` leaves out what cannot hold a run; equal keys of unequal words
    only make a stretch longer.  Each stretch goes through `automaton_runs`.
    """
    n = len(words)
    if n < least:
        return []
    keys = np.fromiter(map(hash, words), dtype=np.int64, count=n)
    out = []
    for start, stop in repeating_stretches(keys, least, exponent):
        number: dict[bytes, int] = {}
        own = [number.setdefault(w, len(number)) for w in words[start:stop]]
        out += [(start + a, size, q) for a, size, q in automaton_runs(own, least, exponent)]
    out.sort(key=lambda r: (r[0], r[2]))
    return out


def without_repeats(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words, each run cut to its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, q in runs:
        change[start + q] += 1
        change[start + size] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(
    docs: DataFrame,
    least: int = 24,
    exponent: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Periodic runs of words of every whole text: ``id_col``, ``n_words``, ``runs``, ``collapsed``.

    Words are what stands between spaces and the controls 9 to 13, numbered from 0.
    A run is a stretch of at least ``least`` words and ``exponent`` (3 or more) times its
    smallest period that no neighbouring word extends; ``runs`` lists ``start``,
    ``length``, ``period`` by start, then period.  ``collapsed`` is the text without the
    words that a run holds after its first period, joined by one space.

    One task a row and no shuffle.  Memory goes with the longest text: about 20 bytes a
    word, and 300 a word of a stretch that repeats itself.  A null or empty text
    has no words, no runs and an empty ``collapsed``; rows that repeat an id are handled
    each on its own, a null id too; other columns are ignored; an empty table gives no rows.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = to_arrow_type(docs.schema[id_col].dataType)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            sizes, found, kept = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").split()
                runs = word_runs(words, least, exponent)
                sizes.append(len(words))
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                kept.append(without_repeats(words, runs))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(kind), pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(run)), pa.array(kept, pa.binary()),
                ],
                ["a", "n_words", "runs", "collapsed"],
            )

    a = docs.schema[id_col].dataType.simpleString()
    schema = f"a {a}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return (
        docs.select(F.col(id_col).alias("a"), F.col(text_col).cast("binary").alias("t"))
        .mapInArrow(find, schema)
        .select(F.col("a").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
    )
