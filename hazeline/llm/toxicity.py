"""Toxicity: Levenshtein automata intersected with a lexicon trie, and a score of the context."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StringType, StructField, StructType
)

from hazeline.llm import arrays
from hazeline.llm.quality import labelled, sigmoid
from hazeline.llm.tables import stored

#: Labelled documents a lexicon is learned from, at most; chosen by a hash of their ids.
FITTED = 8000
#: Shortest and longest beginning of a word that can become a term, in characters.
STEMS = range(3, 15)
#: Words on each side of a match that tell whether it is quoted.
WINDOW = 6
#: Most that one match can say, as a logarithm of odds.
STRONGEST = 6.0
#: Least that a term must say over all its words in the sample.
LEAST_SAID = 15.0
#: What a term must say to count where others explain the documents, too, per toxic document.
SURE = 0.1
#: Matches in a context that its usual share weighs as much as.
USUAL = 20
#: Share of the rarer words that makes two documents copies of each other.
COPY = 0.3

# Characters often written for letters, quotation marks, verbs and nouns of reporting.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
INNER = "@$!*"
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’", "‹": "›"}
REPORTING = frozenset(
    "said says say wrote writes called calls quoted quote quotes word words term slur phrase "
    "sagte sagt schrieb nannte zitat wort begriff dit disait citation mot terme "
    "dijo dice escribió cita palabra término".split()
)


@lru_cache(maxsize=1)
def _word_characters() -> np.ndarray:
    """2 for letters, digits and marks within words, 1 for characters that count between two of
    those, 0 for all others, by code point."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if chr(c).isalnum()]] = 2
    kinds[[ord(c) for c in INNER]] = 1
    return kinds


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words among code points; a 0 separates texts."""
    kinds = _word_characters()[codes]
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = kinds == 2
    inner = np.flatnonzero(kinds == 1) + 1
    inside[inner[inside[inner - 1] & inside[inner + 1]]] = True
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])


def distance_allowed(term: str, stem: bool) -> int:
    """How many misspellings a term may have: a short one has too many neighbours."""
    return int(len(term) >= 5) if stem else int(len(term) >= 4) + int(len(term) >= 9)


class Automaton:
    """All words within the allowed Levenshtein distance of a lexicon, as one table.

    The terms form a trie. A state of a term's Levenshtein automaton says how much of the term is
    read at how many errors; intersecting with the trie, it is a set of (node, errors), of which
    only the cheapest per node counts. These sets, found by breadth first, are the rows of the
    table, so that each character of a word costs one lookup, whatever the lexicon.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        children: list[dict[str, int]] = [{}]
        most, whole, stem = [0], {}, {}
        for number, (term, is_stem) in enumerate(terms):
            allowed, node = distance_allowed(term, is_stem), 0
            most[0] = max(most[0], allowed)
            for letter in term:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    most.append(0)
                node = children[node][letter]
                most[node] = max(most[node], allowed)
            (stem if is_stem else whole)[node] = number
        letters = sorted({letter for term, _ in terms for letter in term})
        self.kinds = np.zeros(0x110000, np.uint8)
        for number, letter in enumerate(letters, 1):
            self.kinds[ord(letter)] = number
        for written, meant in LOOKALIKES.items():
            if not self.kinds[ord(written)]:
                self.kinds[ord(written)] = self.kinds[ord(meant)]

        def closed(states: dict[int, int]) -> tuple:
            waiting = list(states.items())
            while waiting:  # letters of a term that the word leaves out
                node, errors = waiting.pop()
                for child in children[node].values():
                    if errors + 1 <= most[child] and errors + 1 < states.get(child, 99):
                        states[child] = errors + 1
                        waiting.append((child, errors + 1))
            return tuple(sorted(states.items()))

        def step(state: tuple, letter: str | None) -> tuple:
            after: dict[int, int] = {}
            for node, errors in state:
                if errors + 1 <= most[node]:  # a letter too many
                    after[node] = min(after.get(node, 99), errors + 1)
                for own, child in children[node].items():
                    cost = errors + (own != letter)
                    if cost <= most[child]:
                        after[child] = min(after.get(child, 99), cost)
            return closed(after)

        first = closed({0: 0})
        numbers, order, table = {(): 0, first: 1}, [(), first], [[0] * (len(letters) + 1)]
        at = 1
        while at < len(order):
            row = []
            for letter in (None, *letters):
                after = step(order[at], letter)
                if after not in numbers:
                    numbers[after] = len(order)
                    order.append(after)
                row.append(numbers[after])
            table.append(row)
            at += 1
        self.table = np.array(table, np.int32)

        def accepted(ends: dict[int, int], is_stem: bool) -> tuple[np.ndarray, np.ndarray]:
            term, errors = np.full(len(order), -1, np.int32), np.full(len(order), 99, np.int8)
            for number, state in enumerate(order):
                for node, cost in state:
                    if node in ends and cost < errors[number] and cost <= distance_allowed(*terms[ends[node]]):
                        term[number], errors[number] = ends[node], cost
            return term, errors

        self.whole, self.stem = accepted(whole, False), accepted(stem, True)

    def matches(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Word, term and errors of each word that is a term, or begins with a stem, or nearly so."""
        kinds = self.kinds[codes]
        best = np.full(len(starts), 99, np.int8)
        term = np.full(len(starts), -1, np.int32)
        words = np.arange(len(starts))
        state = np.ones(len(starts), np.int32)
        lengths = ends - starts
        at = 0
        while len(words):
            state = self.table[state, kinds[starts[words] + at]]
            at += 1
            for (terms, errors), here in (
                (self.stem, slice(None)),
                (self.whole, lengths[words] == at),
            ):
                cost = errors[state[here]]
                better = cost < best[words[here]]
                if better.any():
                    found = words[here][better]
                    best[found], term[found] = cost[better], terms[state[here]][better]
            going = (state > 0) & (lengths[words] > at)
            words, state = words[going], state[going]
        hit = np.flatnonzero(term >= 0)
        return hit, term[hit], best[hit]


@dataclass
class Lexicon:
    """Terms, and what a match says, as a logarithm of odds.

    ``evidence`` is by term and number of errors, ``shares`` is what a quotation or a report
    leaves of it, ``weights`` are those of a constant, of the evidence of a text added up, and of
    the logarithm of its length in words.
    """

    terms: list[tuple[str, bool]]
    evidence: dict[tuple[int, int], float] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=lambda: {"quoted": 0.3, "reported": 0.6, "plain": 1.0})
    weights: tuple[float, float, float] = (-3.0, 1.0, -0.2)


@lru_cache(maxsize=4)
def _automaton(terms: tuple[tuple[str, bool], ...]) -> Automaton:
    return Automaton(list(terms))


def quotation(text: str, start: int, end: int) -> str:
    """How the words around a match speak of it: ``quoted``, ``reported`` or ``plain``.

    Quoted is a match between two quotation marks of a kind within the window; reported is one
    with a word of reporting there.
    """
    width = WINDOW * 12
    before, after = text[max(0, start - width) : start], text[end : end + width]
    for opening, closing in QUOTES.items():
        if opening == closing:
            open_before = before.count(opening) % 2 == 1
        else:
            open_before = before.rfind(opening) > before.rfind(closing)
        if open_before and closing in after:
            return "quoted"
    near = [*re.findall(r"\w+", before)[-WINDOW:], *re.findall(r"\w+", after)[:WINDOW]]
    return "reported" if REPORTING.intersection(near) else "plain"


def hits(texts: list[str], terms: tuple[tuple[str, bool], ...]) -> tuple[list[list[tuple]], list[int]]:
    """Term, errors, start, end and context of each match in each text, in order; words per text."""
    found: list[list[tuple[int, int, int, int, str]]] = [[] for _ in texts]
    folded = [_folded(text) for text in texts]
    codes = points("\0".join(folded))
    starts, ends = spans(codes)
    begins = np.cumsum([0, *(len(text) + 1 for text in folded)])
    counts = np.diff(np.searchsorted(starts, begins)).tolist()
    if not terms:
        return found, counts
    for word, term, errors in zip(*_automaton(terms).matches(codes, starts, ends), strict=True):
        number = int(np.searchsorted(begins, starts[word], "right")) - 1
        start, end = int(starts[word] - begins[number]), int(ends[word] - begins[number])
        found[number].append((int(term), int(errors), start, end, quotation(folded[number], start, end)))
    return found, counts


def _folded(text: str) -> str:
    """Lower case, character by character, so that positions stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c.lower() if len(c.lower()) == 1 else c for c in text])


def evidence(matches: list[tuple[int, int, int, int, str]], lexicon: Lexicon) -> float:
    """What the matches of a text say together."""
    return sum(lexicon.evidence.get((m[0], m[1]), 0.0) * lexicon.shares[m[4]] for m in matches)


def judged(said: np.ndarray, words: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    constant, weight, length = lexicon.weights
    return sigmoid(constant + weight * np.minimum(said, 5 * STRONGEST) + length * np.log1p(words))


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in STEMS if n <= len(word)]


def _words(text: str) -> set[str]:
    folded = _folded(text)
    starts, ends = spans(points(folded))
    return {folded[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", fitted: int = FITTED, **options) -> Lexicon:
    """A lexicon from ``labels`` of documents that are not held out, at most ``fitted`` of them.

    Terms are words and beginnings of words that many toxic documents have and hardly any other.
    Texts that are alike count once. The driver gets the distinct words of the sample's toxic
    documents and counts for beginnings of those words, never texts.
    """
    found = labelled(docs, labels, label, fitted, **options)
    # A text that several documents have is toxic if one of them is.
    alike = found.groupBy("text").agg(F.min("_id").alias("_id"), F.max("y").alias("y"))
    sample = stored(alike.select("_id", "text", "y"), "toxic-sample")

    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(_words(text or "")) for text in batch.column("text").to_pylist()]
            yield pa.record_batch({"words": pa.array(lists, pa.list_(pa.string()))})

    toxic = sample.filter("y = 1").select("text", "_id")
    lists = toxic.orderBy("_id").select("text").mapInArrow(distinct, "words array<string>").collect()
    bad = _unlike([set(row.words) for row in lists])
    if not bad:
        return Lexicon([])
    least = max(6, len(bad) // 100)
    support: Counter[str] = Counter()
    for own in bad:
        support.update({stem for word in own for stem in _beginnings(word)})
    candidates = frozenset(stem for stem, n in support.items() if n >= least)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = _words(text or "")
                counts[""] += len(own)
                known = (word for word in own if word[: STEMS[0]] in candidates)
                counts.update(stem for word in known for stem in _beginnings(word) if stem in candidates)
        yield pa.record_batch({"stem": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    harmless = Counter(
        {
            row.stem: row.n
            for row in sample.filter("y = 0").select("text").mapInArrow(counted, "stem string, n long")
            .groupBy("stem").agg(F.sum("n").alias("n")).collect()
        }
    )
    lexicon = Lexicon(_chosen(bad, harmless, candidates, least))
    _weigh(lexicon, sample)
    return lexicon


def _chosen(bad: list[set[str]], harmless: Counter, candidates: frozenset, least: int) -> list[tuple[str, bool]]:
    """Terms by how much they tell: the beginning that best separates the words of toxic
    documents from those of others, then the best for the words left, and so on.

    A beginning tells the number of words with it times the logarithm of how much more frequent
    it is than elsewhere; of beginnings that tell the same, the longest is the term. What tells
    less than ``LEAST_SAID`` may be chance, as so many beginnings are tried. A term that tells less
    than ``SURE`` counts only for documents that no term found before explains.
    """
    more = max(1, harmless[""]) / max(1, sum(map(len, bad)))
    with_stem: dict[str, set[tuple[int, str]]] = defaultdict(set)
    for number, own in enumerate(bad):
        for word in own:
            for stem in _beginnings(word):
                if stem in candidates:
                    with_stem[stem].add((number, word))

    def tells(stem: str) -> float:
        n = len(with_stem[stem])
        ratio = n * more / (harmless[stem] + 3)
        said = n * np.log(ratio) if ratio >= 6 and n >= least else 0.0
        return said if said >= LEAST_SAID else 0.0

    value = {stem: tells(stem) for stem in with_stem}
    chosen, explained = [], set()
    while value:
        best = max(value, key=lambda stem: (round(value[stem], 6), len(stem), stem))
        if value[best] <= 0:
            break
        if not explained and value[best] < SURE * len(bad):
            # From here on only documents without a sure term count.
            explained = {number for number, own in enumerate(bad) if any(_has(own, term) for term in chosen)}
            for stem, pairs in with_stem.items():
                with_stem[stem] = {pair for pair in pairs if pair[0] not in explained}
            explained.add(-1)
            value = {stem: tells(stem) for stem in with_stem}
            continue
        pairs = set(with_stem[best])
        if len({number for number, _ in pairs}) >= least:
            exact = sum(word == best for _, word in pairs)
            chosen.append((best, exact < 0.9 * len(pairs)))
        gone = pairs
        if explained:
            numbers = {number for number, _ in pairs}
            gone = {(number, word) for number in numbers for word in bad[number]}
        touched = {best}
        for pair in gone:
            for stem in _beginnings(pair[1]):
                if stem in candidates:
                    with_stem[stem].discard(pair)
                    touched.add(stem)
        value |= {stem: tells(stem) for stem in touched}
    return sorted(chosen)


def _has(words: set[str], term: tuple[str, bool]) -> bool:
    return any(word.startswith(term[0]) for word in words) if term[1] else term[0] in words


def _unlike(documents: list[set[str]]) -> list[set[str]]:
    """Documents of which no earlier one is a near copy, by the words that few of them have.

    The words of a document with many copies would otherwise look as if they told something.
    """
    often = Counter(word for own in documents for word in own)
    rare = max(3, len(documents) // 20)
    kept, having = [], defaultdict(list)
    for own in documents:
        few = [word for word in own if often[word] <= rare]
        shared = Counter(number for word in few for number in having[word])
        if few and shared and max(shared.values()) >= COPY * len(few):
            continue
        for word in few:
            having[word].append(len(kept))
        kept.append(own)
    return kept


def _weigh(lexicon: Lexicon, sample: DataFrame) -> None:
    """Learn from the sample what matches say, by term, errors and context, and how to add it up.

    Where the sample shows little, a match says what misspelled terms usually do.
    """
    terms = tuple(lexicon.terms)
    schema = "y int, kind string, term int, errors int, n long"

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple] = Counter()
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for y, found, words in zip(batch.column("y").to_pylist(), *hits(texts, terms), strict=True):
                counts[y, "words", 0, 0] += words
                for term, errors, _, _, context in found:
                    counts[y, context, term, errors] += 1
        rows = [(*key, n) for key, n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[at] for row in rows], kind) for at, kind in enumerate(
                (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64()))],
            ["y", "kind", "term", "errors", "n"],
        )

    found = sample.select("y", "text").mapInArrow(counted, schema).groupBy("y", "kind", "term", "errors").agg(F.sum("n").alias("n"))
    seen = {(row.y, row.kind, row.term, row.errors): row.n for row in found.collect()}
    words = [max(1, seen.get((y, "words", 0, 0), 0)) for y in (0, 1)]
    doubt = 1.5 / words[0]
    for number, (term, stem) in enumerate(terms):
        for errors in range(distance_allowed(term, stem) + 1):
            others, own = (
                sum(seen.get((y, context, number, errors), 0) for context in lexicon.shares) / words[y] for y in (0, 1)
            )
            usual = (5.0, 4.5, 4.0)[errors]
            said = np.log((own + np.exp(usual) * doubt) / (others + doubt))
            # A misspelling that other documents have, too, is a word of its own.
            enough = said >= (3 if errors else 1)
            lexicon.evidence[number, errors] = float(min(said, STRONGEST)) if enough else 0.0

    lexicon.shares = _shares(lexicon, seen, words)

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches, counts = hits([text or "" for text in batch.column("text").to_pylist()], terms)
            said = [evidence(own, lexicon) for own in matches]
            yield pa.record_batch(
                [batch.column("y"), batch.column("_id").cast(pa.string()), pa.array(said, pa.float64()), pa.array(counts, pa.int64())],
                names=["y", "id", "said", "words"],
            )

    rows = sample.select("y", "_id", "text").mapInArrow(summed, "y int, id string, said double, words long").toArrow().sort_by("id")
    y, said, count = (rows.column(c).to_numpy().astype(float) for c in ("y", "said", "words"))
    x = np.column_stack([np.ones(len(y)), np.minimum(said, 5 * STRONGEST), np.log1p(count)])
    lexicon.weights = tuple(map(float, _regressed(x, y, np.array(Lexicon([]).weights), np.array([1.0, 4.0, 4.0]))))


def _shares(lexicon: Lexicon, seen: dict[tuple, int], words: list[int]) -> dict[str, float]:
    """What each context leaves of a match: the logarithm of odds that matches in it have, by that of plain ones.

    Counted are matches of terms that say something. The usual share weighs as much as ``USUAL`` matches
    in the context, so that a sample with few of them hardly changes it, and one with none not at all.
    """
    count = {context: [0, 0] for context in lexicon.shares}
    for (y, context, term, errors), n in seen.items():
        if context in count and lexicon.evidence.get((term, errors), 0.0) > 0:
            count[context][y] += n

    def said(context: str) -> float:
        others, own = ((n + 0.5) / of for n, of in zip(count[context], words, strict=True))
        return float(np.log(own / others))

    plain = said("plain")
    learned = dict(lexicon.shares)
    if plain > 0:
        for context, usual in lexicon.shares.items():
            n = sum(count[context])
            if context != "plain" and n:
                found = min(1.0, max(0.0, said(context) / plain))
                learned[context] = (usual * USUAL + found * n) / (USUAL + n)
    return learned


def _regressed(x: np.ndarray, y: np.ndarray, prior: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, each step halved until it helps.

    ``held`` says how firmly weights are held to the usual ones, where the sample decides nothing.
    """

    def loss(weights: np.ndarray) -> float:
        z = x @ weights
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + (held * (weights - prior) ** 2).sum() / 2)

    weights = prior.copy()
    for _ in range(30):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + held * (weights - prior)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(held), slope)
        while loss(weights - step) > loss(weights) and np.abs(step).max() > 1e-9:
            step /= 2
        weights = weights - step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def score(
    df: DataFrame, lexicon: Lexicon, *, text_col: str = "text", score_col: str = "score",
    keep: Iterable[str] | None = None, matches: bool = False,
) -> DataFrame:
    """Add the toxicity of each text, between 0 and 1, to the columns of ``df`` or those in ``keep``.

    ``matches`` adds the terms found, with errors, place (in characters) and context. Null texts
    count as empty; without a match, or with an empty lexicon, the score is low. Columns named like those added are replaced. Rows are judged one by one, so repeated
    rows, ties and an empty table need no rule; texts are read whole.
    """
    added = [StructField(score_col, DoubleType())]
    if matches:
        match = StructType(
            [
                StructField("term", StringType()),
                *(StructField(name, IntegerType()) for name in ("errors", "start", "end")),
                StructField("context", StringType()),
            ]
        )
        added.append(StructField("matches", ArrayType(match)))
    taken = {f.name for f in added}
    names = [c for c in (df.columns if keep is None else keep) if c not in taken]
    schema = StructType([*[df.schema[c] for c in names], *added])
    terms = tuple(lexicon.terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = arrays.texts(batch.column(text_col))
            for start, end in arrays.steps(offsets):
                part = batch.slice(start, end - start)
                found, counts = hits([text or "" for text in part.column(text_col).to_pylist()], terms)
                said = np.array([evidence(own, lexicon) for own in found], float)
                columns = {score_col: pa.array(judged(said, np.array(counts, float), lexicon))}
                if matches:
                    rows = [
                        [{"term": terms[t][0], "errors": e, "start": a, "end": b, "context": c} for t, e, a, b, c in own]
                        for own in found
                    ]
                    kind = pa.struct(
                        [("term", pa.string()), ("errors", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("context", pa.string())]
                    )
                    columns["matches"] = pa.array(rows, pa.list_(kind))
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *columns.values()], schema.names)

    return df.select(*{text_col: None, **dict.fromkeys(names)}).mapInArrow(run, schema)
