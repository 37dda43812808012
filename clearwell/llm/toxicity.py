"""Toxicity: misspelled lexicon terms by Levenshtein automata, weighed by their context."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.llm.common import fold, free_name, labelled_sample, sampled_texts, slices, written

WORD = re.compile(r"[^\W_](?:[\w*@$!'’-]*[^\W_])?")
#: Characters often put for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
#: Words that announce a quotation, and words that address someone.
REPORTING = frozenset(
    "said says saying called calling wrote writes quote quoted quoting word words term terms phrase sagte sagt"
    " nannte zitat wort dit disait citation mot dijo dice cita palabra".split()
)
ADDRESSING = frozenset(
    "you your you're youre u ur du dich dein ihr euch tu te toi ton vous tú usted eres es est".split()
)
QUOTE_OR_LINE = re.compile("[\"“”„«»‹›‘`\n]")
#: A worker remembers so many words at most, none longer than this.
CACHED_WORDS, CACHED_LETTERS = 300_000, 64


class FuzzyLexicon:
    """Words within a few edits of a lexicon term.

    The terms form a trie.  A state of the automaton is a set of (trie node, edits
    spent): the product of the trie with the Levenshtein automata of all its terms.
    States and transitions are made when a word first needs them, so a word costs one
    lookup a letter and most end after a few letters in the empty state.

    ``edits`` lists (least term length, edits); terms shorter than all match exactly.
    A term that ends in ``*`` is a stem: words that begin with it match, without edits.
    ``ordinary`` words are no misspellings: they match as they stand or not at all.
    """

    def __init__(
        self,
        terms: Sequence[str],
        edits: Sequence[tuple[int, int]] = ((5, 1), (10, 2)),
        ordinary: Sequence[str] = (),
    ) -> None:
        self.ordinary = frozenset(ordinary)
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int | None] = [None]
        self.most = [0]  # edits allowed to any term below the node
        self.allowed: list[int] = []
        self.rest: dict[int, int] = {}  # node at the end of a stem -> node for whatever follows
        for k, term in enumerate(terms):
            stem = term.endswith("*")
            budget = 0 if stem else max([0, *(e for n, e in edits if len(term) >= n)])
            self.allowed.append(budget)
            node = 0
            self.most[0] = max(self.most[0], budget)
            for c in term.removesuffix("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], budget)
            if stem:
                self.rest[node] = len(self.children)
                self.rest[len(self.children)] = len(self.children)
                self.children.append({})
                self.term.append(k)
                self.most.append(0)
            else:
                self.term[node] = k
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.known: dict[str, tuple[int, int] | None] = {}
        self.dead = self._state(frozenset())
        self.start = self._state(self._closure({0: 0}))

    def _closure(self, spent: dict[int, int]) -> frozenset:
        """Skipped letters of a term cost an edit each."""
        todo = list(spent)
        while todo:
            node = todo.pop()
            cost = spent[node] + 1
            for child in self.children[node].values():
                if cost <= self.most[child] and cost < spent.get(child, 99):
                    spent[child] = cost
                    todo.append(child)
        for node, cost in list(spent.items()):
            if node in self.rest and not cost:
                spent[self.rest[node]] = 0
        return frozenset(spent.items())

    def _state(self, members: frozenset) -> int:
        if members not in self.ids:
            self.ids[members] = len(self.states)
            self.states.append(members)
            self.next.append({})
            ends = [
                (cost, self.term[node])
                for node, cost in members
                if self.term[node] is not None and cost <= self.allowed[self.term[node]]
            ]
            self.accepts.append(min(ends) if ends else None)
        return self.ids[members]

    def _step(self, state: int, letter: str) -> int:
        spent: dict[int, int] = {}

        def put(node: int, cost: int) -> None:
            if cost <= self.most[node] and cost < spent.get(node, 99):
                spent[node] = cost

        for node, cost in self.states[state]:
            put(node, cost + 1)  # a letter too many
            if self.rest.get(node) == node:
                put(node, cost)
            for c, child in self.children[node].items():
                put(child, cost if c == letter else cost + 1)
        to = self.next[state][letter] = self._state(self._closure(spent))
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, index of the term) of the nearest term, or None."""
        known = self.known
        if word in known:
            return known[word]
        state, following = self.start, self.next
        for letter in word:
            to = following[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state == self.dead:
                break
        found = self.accepts[state]
        if found is not None and found[0] and word in self.ordinary:
            found = None
        if len(word) <= CACHED_LETTERS:
            if len(known) >= CACHED_WORDS:
                known.clear()
            known[word] = found
        return found


FEATURES = ("exact", "exact_quoted", "near", "near_quoted", "density", "addressed", "terms")
#: A quoted hit never counts more than the same hit outside a quotation.
QUOTED = ((0, 1), (2, 3))


def context_features(text: str | None, lexicon: FuzzyLexicon, weights: Sequence[float], window: int = 6) -> list[float]:
    """What a text says with lexicon terms, in the order of `FEATURES`; all 0 without any.

    A hit inside quotation marks (after an odd number of them in its whole line, and
    before another), on a line that starts with ``>``, or shortly after a reporting word is
    quoted; one near an addressing word is addressed.
    """
    if not text:
        return [0.0] * len(FEATURES)
    low = text.lower()
    distinct = set(WORD.findall(low))
    hits = {}
    for w in distinct:
        found = lexicon.match(w)
        if found is None and not w.isalpha():
            found = lexicon.match(w.translate(LEET))
        if found is not None:
            hits[w] = found
    if not hits:
        return [0.0] * len(FEATURES)
    spans = [(m.group(), m.start(), m.end()) for m in WORD.finditer(low)]
    sums = [0.0, 0.0, 0.0, 0.0]
    addressed, terms = 0, set()
    lines = _Lines(low)
    for i, (w, start, end) in enumerate(spans):
        found = hits.get(w)
        if found is None:
            continue
        edits, term = found
        before = [x[0] for x in spans[max(0, i - window) : i]]
        after = [x[0] for x in spans[i + 1 : i + 1 + window]]
        quoted = not REPORTING.isdisjoint(before[-3:]) or lines.quoted(start, end)
        sums[2 * bool(edits) + quoted] += weights[term]
        addressed += not quoted and not (ADDRESSING.isdisjoint(before) and ADDRESSING.isdisjoint(after))
        if not quoted and not edits:
            terms.add(term)
    return [math.log1p(s) for s in sums] + [
        math.log1p(100 * sum(sums) / len(spans)),
        math.log1p(addressed),
        math.log1p(len(terms)),
    ]


class _Lines:
    """Where a text's lines end and its quotation marks stand."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.ends: list[int] = []
        self.marks: list[int] = []
        for m in QUOTE_OR_LINE.finditer(text):
            (self.ends if m.group() == "\n" else self.marks).append(m.start())

    def quoted(self, start: int, end: int) -> bool:
        at = bisect_left(self.ends, start)
        line = self.ends[at - 1] + 1 if at else 0
        stop = self.ends[at] if at < len(self.ends) else len(self.text)
        if self.text[line : line + 4].lstrip().startswith(">"):
            return True
        before = bisect_left(self.marks, start) - bisect_left(self.marks, line)
        return before % 2 == 1 and bisect_left(self.marks, end) < bisect_left(self.marks, stop)


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    term_weights: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float
    ordinary: tuple[str, ...] = ()

    def scorer(self):
        lexicon = FuzzyLexicon(self.terms, ordinary=self.ordinary)

        def score(text: str | None) -> float:
            x = context_features(text, lexicon, self.term_weights)
            z = self.intercept + sum(a * b for a, b in zip(self.weights, x, strict=True))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def distinct_words(sample: DataFrame, stems: Sequence[int] = ()) -> DataFrame:
    """``label`` and ``words`` of rows ``sample_id``, ``text``, ``label``, near copies once.

    Of texts of one label that agree in both of two minima over hashed three-word
    shingles the one with the least id stays.  Words have three letters at least; with
    ``stems``, their beginnings of these lengths are words too, ending in ``*``.
    """

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b, words = [], [], []
            for text in batch.column("text").to_pylist():
                seen = WORD.findall((text or "").lower())
                grams = [" ".join(seen[i : i + 3]) for i in range(max(1, len(seen) - 2))]
                a.append(min(xxhash.xxh64_intdigest(g, 1) >> 1 for g in grams))
                b.append(min(xxhash.xxh64_intdigest(g, 2) >> 1 for g in grams))
                own = {w for w in seen if w.isalpha() and len(w) > 2}
                words.append(sorted(own | {f"{w[:n]}*" for w in own for n in stems if n < len(w)}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sample_id"), batch.column("label"), pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()), pa.array(words, pa.list_(pa.string())),
                ],
                ["sample_id", "label", "a", "b", "words"],
            )

    kind = sample.schema["sample_id"].dataType.simpleString()
    seen = sample.select("sample_id", "label", "text").mapInArrow(
        minima, f"sample_id {kind}, label int, a long, b long, words array<string>"
    )
    least = F.min(F.struct("sample_id", "words"))
    return written(seen.groupBy("label", "a", "b").agg(least["words"].alias("words")).select("label", "words"), "toxic-words")


def word_counts(one: DataFrame) -> DataFrame:
    """``word`` and in how many toxic (``a``) and clean (``b``) texts it stands."""
    words = one.select("label", F.explode("words").alias("word"))
    return words.groupBy("word").agg(
        F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b")
    )


def learn_lexicon(one: DataFrame, least_texts: int = 3, least_gain: float = 15.0) -> list[tuple[str, float]]:
    """Terms that mark toxic texts, with their weights, from `distinct_words`.

    A word is kept if it is in ``least_texts`` toxic texts at least, is far more likely
    there, and its likelihood-ratio statistic reaches ``least_gain``.
    """
    size = one.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).head()
    n1, n0 = float(size["toxic"] or 0), float(size["all"] - (size["toxic"] or 0))
    if not n1 or not n0:
        return []
    a, b = F.col("a"), F.col("b")
    rate, rest = (a + b) / (n1 + n0), 1 - (a + b) / (n1 + n0)

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    gain = 2 * (
        part(a, rate * n1) + part(b, rate * n0) + part(n1 - a, rest * n1) + part(n0 - b, rest * n0)
    )
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    rows = (
        word_counts(one)
        .where(a >= least_texts)
        .select("word", gain.alias("gain"), odds.alias("odds"))
        .where((F.col("gain") >= least_gain) & (F.col("odds") >= 2.5))
        .orderBy(F.desc("gain"), "word")
        .collect()
    )
    return [(r["word"], float(r["odds"])) for r in rows]


def ordinary_words(one: DataFrame, terms: Sequence[str], least_texts: int = 2) -> list[str]:
    """Words near a term that stand in clean texts as words of their own, not as misspellings."""
    known = list(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = FuzzyLexicon(known)
        for batch in batches:
            found = [lexicon.match(w) for w in batch.column("word").to_pylist()]
            yield batch.filter(pa.array([f is not None and f[0] > 0 for f in found], pa.bool_()))

    clean = word_counts(one).where(F.col("b") >= least_texts).select("word")
    return sorted(r["word"] for r in clean.mapInArrow(near, "word string").collect())


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalised logistic regression by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) / len(a) - ridge @ w
        curve = (a * (p * (1 - p))[:, None]).T @ a / len(a) + ridge
        step = np.linalg.solve(curve, gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def monotone_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """`logistic` with no weight below 0, and no quoted one above its plain one.

    A weight that comes out negative is held at 0 and the others are fitted again.
    """
    free = np.arange(x.shape[1])
    weights = np.zeros(x.shape[1])
    while True:
        w, intercept = logistic(x[:, free], y)
        if (w >= 0).all():
            break
        free = free[w >= 0]
    weights[free] = w
    for plain, quoted in QUOTED:
        weights[quoted] = min(weights[quoted], weights[plain])
    return weights, intercept


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 4,
    held_out: int = 2,
    fit_rows: int = 16_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Lexicon and weights from at most ``fit_rows`` labelled rows outside the held-out fold.

    Up to half of the rows are toxic; classes are weighed back to their true shares
    by the intercept.  No hit lowers a score (`monotone_logistic`).  Without both classes there is no lexicon, and every text gets
    the share of toxic labels.
    """
    sample = labelled_sample(labels, label, folds, held_out, fit_rows, id_col)
    shares = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(F.col(id_col), folds) != held_out))
        .agg(F.avg(F.col(label).cast("double")).alias("p"))
        .head()["p"]
    )
    share = min(max(shares or 0.0, 1e-4), 1 - 1e-4)
    texts = written(sampled_texts(docs, sample, id_col, text_col), "toxic-sample")
    one = distinct_words(texts)
    lexicon = learn_lexicon(one)
    terms, weights = tuple(t for t, _ in lexicon), tuple(w for _, w in lexicon)
    prior = math.log(share / (1 - share))
    flat = ToxicityModel(terms, weights, (0.0,) * len(FEATURES), prior)
    if not terms:
        return flat
    ordinary = tuple(ordinary_words(one, terms))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = FuzzyLexicon(terms, ordinary=ordinary)
        for batch in slices(batches):
            x = [context_features(t, automaton, weights) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sample_id"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["sample_id", "label", "x"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = (
        texts.select("sample_id", "label", "text")
        .mapInArrow(measure, f"sample_id {kind}, label int, x array<double>")
        .orderBy("sample_id")
        .select("label", "x")
        .collect()
    )
    y = np.array([r["label"] for r in rows], dtype=float)
    if y.min() == y.max():
        return flat
    w, intercept = monotone_logistic(np.array([r["x"] for r in rows]), y)
    drawn = y.mean()
    shifted = intercept - math.log(drawn / (1 - drawn)) + prior
    return ToxicityModel(terms, weights, tuple(map(float, w)), shifted, ordinary)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """Score every whole text; adds the struct ``toxicity`` to the rows.

    ``toxicity`` has ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from the
    threshold on); its name gets underscores in front if ``docs`` has one.  One pass
    in one task a row, no shuffle; only the text enters the score.

    A null or empty text has no hits and scores as the lexicon-free rest.  A null id is
    not held out; repeated rows and ids are scored each on its own; an empty table
    gives no rows.
    """
    name, raw = free_name(docs, "toxicity"), free_name(docs, "_toxicity_score")
    schema = T.StructType([*docs.schema.fields, T.StructField(raw, T.DoubleType())])
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in slices(batches):
            values = [score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, raw]
            )

    return docs.mapInArrow(add, schema).select(
        *docs.columns,
        F.struct(
            F.coalesce(fold(F.col(id_col), folds) == held_out, F.lit(False)).alias("held_out"),
            F.col(raw).alias("score"),
            (F.col(raw) >= threshold).cast("int").alias("predicted"),
        ).alias(name),
    )
