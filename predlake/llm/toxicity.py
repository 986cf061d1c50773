"""Toxicity from a learned lexicon, matched by Levenshtein automata over a trie.

An edit is a letter more, less or other, or two neighbours that have changed places.

Learning finds the words and word beginnings that explain the labelled toxic
documents (a greedy cover) and are hardly ever found in the others; with the
words that begin like that, whose misspellings no beginning finds, they form a
trie. Every distinct word of a text is turned into a Levenshtein automaton and
intersected with the trie, which gives the entries that it spells or misspells.
An entry's evidence is its log-odds among the labelled documents; a misspelling
has log-odds of its own, as a misspelt entry may be a common word. Words around
a match decide whether it is quoted or aimed at someone, which scales the
evidence. Evidence and prior sum up to the log-odds of the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, materialise, per_process, split_of

FIT_ROWS = 20_000       # labelled documents at most
HELD_OUT = (3, 1)       # ids with crc32 mod 3 == 1 are never learned from
TOXIC = 0.7             # predicted 1 from this score on
LEAST_SUPPORT = 3       # toxic documents that an entry must explain, besides those that others explain
CHANCE = 5e-8           # a term is an entry anyway if all its documents are toxic by chance less often than this
SKETCHES = 4            # toxic texts that share one of so many least shingle hashes count as copies
PURITY = 0.9            # of the documents with an entry so many must be toxic
STEMS = (4, 5, 6)       # lengths of word beginnings that can be entries
WINDOW = 8              # words looked at on each side of a match
QUOTED = 0.25           # evidence of a quoted match
MISSPELT = 0.85         # evidence of a misspelling
AIMED = 1.25            # evidence of a match near a word of address
KEPT_WORDS = 500_000
KEPT_STATES = 200_000
# Quotation marks, words that introduce a quotation, words of address.
OPENING, CLOSING = "\"'“„«‘‚›", "\"'”“»’‘‹"
REPORTING = {"said", "says", "called", "quote", "quoted", "wrote", "word", "term", "sagte", "wort", "dit", "mot", "dijo", "palabra"}
ADDRESS = {"you", "your", "you're", "u", "du", "dich", "dir", "ihr", "tu", "toi", "te", "vous", "tú", "usted", "vosotros"}
LETTERS = re.compile(r"[^\W\d_]+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(token: str) -> list[str]:
    return LETTERS.findall(token.lower())


def whole_of(token: str) -> str:
    """The token without the signs around it; a digit or sign inside stays and costs an edit."""
    return EDGES.sub("", token.lower())


def allowed(entry: str) -> int:
    """Edits that an entry may be misspelt by; beginnings of words must be exact. What a short entry's misspellings
    are worth, their log-odds decide, as they may be common words."""
    return 0 if entry.endswith("*") or len(entry) < 3 else 1 if len(entry) < 9 else 2


class Automaton:
    """The Levenshtein automaton of a lexicon, on its trie, made deterministic as words need it.

    A state is a set of (trie node, edits so far): all places in the trie that a word's
    letters may have led to; with a letter as well, the place is reached if that letter
    comes next, as two have changed places. A place is dropped once its edits exceed what any entry
    below it allows, and the empty set ends a word early. Beginnings of words match where
    their node is reached without an edit. ``limits`` says how many edits an entry is worth
    looking for, if fewer than it allows.
    """

    def __init__(self, entries: list[str], limits: dict[str, int] | None = None) -> None:
        self.limit = {e: allowed(e) if limits is None else min(limits[e], allowed(e)) for e in entries}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]
        self.reach = [0]
        for e in entries:
            node = 0
            self.reach[0] = max(self.reach[0], self.limit[e])
            for c in e.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], self.limit[e])
            self.ends[node].append(e)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[list[tuple[str, int]]] = []  # if the word ends here
        self.begins: list[list[tuple[str, int]]] = []   # whatever follows
        self.places: list[frozenset] = []
        self._state({(0, 0)})

    def _state(self, places: set[tuple]) -> int:
        todo = [p for p in places if len(p) == 2]
        while todo:  # a letter of the entry is missing in the word
            node, edits = todo.pop()
            for below in self.children[node].values():
                if edits < self.reach[below] and (below, edits + 1) not in places:
                    places.add((below, edits + 1))
                    todo.append((below, edits + 1))
        key = frozenset(places)
        if key not in self.ids:
            self.ids[key] = len(self.places)
            least: dict[str, int] = {}
            for node, edits in (p for p in key if len(p) == 2):
                for e in self.ends[node]:
                    if edits <= self.limit[e] and edits < least.get(e, 9):
                        least[e] = edits
            self.places.append(key)
            self.steps.append({})
            self.accepts.append(sorted((e, d) for e, d in least.items() if not e.endswith("*")))
            self.begins.append(sorted((e, d) for e, d in least.items() if e.endswith("*") and d == 0))
        return self.ids[key]

    def _step(self, state: int, letter: str) -> int:
        """The state after a letter; -1 if nothing can match any more."""
        after = set()
        for node, edits, *next_letter in self.places[state]:
            if next_letter:
                if next_letter[0] == letter:
                    after.add((node, edits))
                continue
            for c, below in self.children[node].items():
                d = edits + (c != letter)
                if d <= self.reach[below]:
                    after.add((below, d))
                swapped = self.children[below].get(letter) if c != letter else None
                if swapped is not None and edits < self.reach[swapped]:
                    after.add((swapped, edits + 1, c))
            if edits < self.reach[node]:
                after.add((node, edits + 1))
        to = self._state(after) if after else -1
        self.steps[state][letter] = to
        return to

    def spelt(self, word: str) -> list[tuple[str, int]]:
        """(entry, edits) of all entries that the word spells or misspells."""
        if len(self.places) > KEPT_STATES:
            self._forget()
        state, found = 0, []
        for c in word:
            to = self.steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if state < 0:
                return found
            if self.begins[state]:
                found = found + self.begins[state]
        return found + self.accepts[state]


def context(tokens: list[str], at: int) -> float:
    """The factor of a match: QUOTED between quotation marks or after a word of reporting, AIMED near a word of address."""
    def opened() -> bool:
        for t in reversed(tokens[max(0, at - WINDOW):at + 1]):
            if t[:1] in OPENING and len(t) > 1:
                return True
            if t is not tokens[at] and t[-1:] in CLOSING:
                return False
        return False

    def closed() -> bool:
        for t in tokens[at:at + WINDOW + 1]:
            if t.rstrip(".,;:!?")[-1:] in CLOSING:
                return True
            if t is not tokens[at] and t[:1] in OPENING:
                return False
        return False

    near = {w for t in tokens[max(0, at - 3):at + 4] for w in words_of(t)}
    if opened() and closed():
        return QUOTED
    if near & REPORTING:
        return (1 + QUOTED) / 2
    return AIMED if near & ADDRESS else 1.0


class Matcher:
    """``odds``: {entry: [log-odds by edits]}; with these only the strongest match of a word counts, else all of its fewest edits."""

    def __init__(self, entries: list[str], odds: dict[str, list[float]] | None = None) -> None:
        # without evidence for a match it need not be found
        self.lexicon = Automaton(entries, None if odds is None else {e: max((d for d, x in enumerate(odds[e]) if x > 0), default=0) for e in entries})
        self.odds = odds
        self.known: dict[str, tuple] = {}
        self.hits: set[str] = set()

    def strongest(self, word: str) -> list[tuple[str, int]]:
        found = self.lexicon.spelt(word)
        if len(found) > 1:
            least = min(d for _, d in found)
            found = [m for m in found if m[1] == least]
            if self.odds is not None:
                found = [max(found, key=lambda m: self.odds[m[0]][m[1]])]
        return found

    def of_token(self, token: str) -> list[tuple[str, int]]:
        """The matches of the token's words, or those of the whole token if it is spelt with fewer edits than any of these."""
        words, whole = words_of(token), whole_of(token)
        found = [m for w in words for m in self.strongest(w)]
        if [whole] != words and whole and (not found or min(d for _, d in found)):
            spelt = self.strongest(whole)
            if spelt and (not found or spelt[0][1] < min(d for _, d in found)):
                return spelt
        return found

    def matches(self, text: str) -> Iterator[tuple[str, int, float]]:
        """(entry, edits, context factor) of every matching word or token of a whole text."""
        tokens = text.split()
        distinct = set(tokens)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
            self.hits.clear()
        for t in [t for t in distinct if t not in self.known]:
            found = tuple(self.of_token(t))
            self.known[t] = found
            if found:
                self.hits.add(t)
        hits = distinct & self.hits
        if hits:
            for at, t in enumerate(tokens):
                if t in hits:
                    factor = context(tokens, at)
                    for entry, edits in self.known[t]:
                        yield entry, edits, factor

    def best(self, text: str) -> dict[str, tuple[int, float]]:
        """Of each entry found: its fewest edits, and the largest factor at these."""
        best: dict[str, tuple[int, float]] = {}
        for entry, edits, factor in self.matches(text):
            had = best.get(entry)
            if had is None or (edits, -factor) < (had[0], -had[1]):
                best[entry] = (edits, factor)
        return best


def log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def cover(terms: dict[str, tuple[set[int], int]], share: float) -> list[str]:
    """The entries besides the forms of beginnings: {term: (groups of toxic documents, clean documents)}, the toxic share -> terms.

    Pure terms in so many groups that chance is ruled out, longest-reaching first, so that a
    word's beginning replaces the words it begins; then, again and again, the term that is in
    most groups that no entry explains. Ties go to the longer term.
    """
    left = {t: set(d) for t, (d, clean) in terms.items() if len(d) >= PURITY * (len(d) + clean)}
    sure = math.log(CHANCE) / math.log(min(0.5, max(share, 1e-6)))

    def rank(t: str) -> tuple:
        return len(left[t]), len(t.rstrip("*")), not t.endswith("*"), t

    chosen: list[str] = []
    while left:
        t = max(left, key=rank)
        gained = left.pop(t)
        if len(gained) < LEAST_SUPPORT:
            break
        chosen.append(t)
        for d in left.values():
            d -= gained
    stems = {t[:-1] for t in chosen if t.endswith("*")}
    for t, (d, clean) in terms.items():
        begun = any(t.rstrip("*")[:n] in stems for n in STEMS)
        if t not in chosen and not t.endswith("*") and not begun and len(d) >= max(LEAST_SUPPORT, sure) and len(d) >= PURITY * (len(d) + clean):
            chosen.append(t)
    return sorted(chosen)


def beginning(word: str, stems: set[str]) -> str | None:
    """The longest of the beginnings that the word begins with, as an entry."""
    return next((word[:n] + "*" for n in reversed(STEMS) if len(word) > n and word[:n] in stems), None)


def _sketch(batches):
    """The least hashes of the three-word shingles of a text, one for each of some hash functions."""
    for pdf in batches:
        rows = []
        for doc, text in zip(pdf.text_id, pdf.text):
            words = text.lower().split()
            shingles = [" ".join(words[i:i + 3]).encode("utf-8", "replace") for i in range(max(1, len(words) - 2))]
            rows += [(doc, n, min(xxhash.xxh64_intdigest(x, n) >> 1 for x in shingles)) for n in range(SKETCHES)]
        yield pd.DataFrame(rows, columns=["text_id", "n", "least"])


def copy_groups(sketches: list[tuple[int, int, int]]) -> dict[int, int]:
    """text_id -> a member of its group; texts with an equal sketch are of one group."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first: dict[tuple[int, int], int] = {}
    for doc, n, least in sketches:
        parent[find(doc)] = find(first.setdefault((n, least), doc))
    return {x: find(x) for x in list(parent)}


def _terms(batches):
    for pdf in batches:
        for doc, y, text in zip(pdf.text_id, pdf.y, pdf.text):
            found = set(words_of(text))
            found |= {w[:n] + "*" for w in found for n in STEMS if len(w) > n}
            found = [t for t in found if len(t) > 2]
            yield pd.DataFrame({"term": pd.Series(found, dtype=object), "text_id": doc, "y": y})


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """The lexicon with its log-odds: {prior, entries: {entry: [log-odds by edits]}, kin: {form: its beginning}}. Equal texts of the sample count once."""
    sample = labelled_sample(docs, labels, "toxic", lambda i: split_of(i, HELD_OUT[0]) != HELD_OUT[1], fit_rows)
    sample = materialise(sample.withColumn("text_id", F.xxhash64("text")).groupBy("text_id")
                         .agg(F.max("y").alias("y"), F.first("text").alias("text")), "labelled")
    counted = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n_toxic, n_clean = counted.get(1, 0), counted.get(0, 0)
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic else -10.0
    if not n_toxic:
        return {"prior": prior, "entries": {}, "kin": {}}
    toxic = sample.where("y = 1").select("text_id", "y", "text").mapInPandas(_terms, "term string, text_id long, y int")
    toxic = materialise(toxic, "toxic-terms")
    often = toxic.groupBy("term").agg(F.count("*").alias("toxic")).where(F.col("toxic") >= LEAST_SUPPORT)
    clean = (sample.where("y = 0").select("text_id", "y", "text").mapInPandas(_terms, "term string, text_id long, y int")
             .join(often, "term", "left_semi").groupBy("term").agg(F.count("*").alias("clean")))
    pure = (often.join(clean, "term", "left").fillna(0, ["clean"]).where(F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean")))
            .select("term", "clean"))
    group = copy_groups([tuple(r) for r in sample.where("y = 1").select("text_id", "text").mapInPandas(
        _sketch, "text_id long, n int, least long").orderBy("text_id", "n").collect()])  # SKETCHES rows a toxic text of the sample
    terms: dict[str, tuple[set[int], int]] = {}  # bounded by the words of the sample's toxic texts
    for r in toxic.join(pure, "term").groupBy("term").agg(
            F.collect_set("text_id").alias("docs"), F.first("clean").alias("clean")).toLocalIterator():
        terms[r["term"]] = ({group[d] for d in r["docs"]}, r["clean"])
    chosen = cover(terms, n_toxic / (n_toxic + n_clean))
    stems = {t[:-1] for t in chosen if t.endswith("*")}
    # the forms of a beginning, however rare: their misspellings are found by words alone
    forms = {r["term"] for r in toxic.where(~F.col("term").endswith("*")).where(
        F.col("term").substr(1, STEMS[0]).isin(sorted({t[:STEMS[0]] for t in stems}))).select("term").distinct().collect()} if stems else set()
    kin = {w: b for w in forms - set(chosen) if (b := beginning(w, stems))}
    entries = sorted({*chosen, *kin})

    def found(batches):
        matcher = Matcher(entries)
        for pdf in batches:
            rows = [(e, d, y) for t, y in zip(pdf.text, pdf.y) for e, (d, _) in matcher.best(t).items()]
            yield pd.DataFrame(rows, columns=["entry", "edits", "y"], dtype=object)

    seen = Counter({(r["entry"], r["edits"], r["y"]): r["count"] for r in sample.select("text", "y").mapInPandas(
        found, "entry string, edits int, y int").groupBy("entry", "edits", "y").count().collect()})
    odds = {}
    for e in entries:
        exact = max(seen[e, 0, 1], LEAST_SUPPORT) if e in kin else seen[e, 0, 1]  # its beginning explains so many at least
        # a misspelling is expected half as often in toxic texts with each edit, and in clean ones as often as seen there
        odds[e] = [log_odds(exact / 2 ** d + (seen[e, d, 1] if d else 0), seen[e, d, 0], n_toxic, n_clean) for d in range(allowed(e) + 1)]
    return {"prior": prior, "entries": odds, "kin": kin}


def evidence(found: dict[str, tuple[int, float]], model: dict) -> float:
    """The score. Words like one entry are often like its neighbours, so only the strongest misspelling counts.

    A beginning and its forms count once, by the strongest match of fewest edits."""
    best: dict[str, tuple[int, float]] = {}
    for e, (d, factor) in found.items():
        x, of = max(0.0, model["entries"][e][d]) * factor, model["kin"].get(e, e)
        if of not in best or (d, -x) < (best[of][0], -best[of][1]):
            best[of] = (d, x)
    parts = best.values()
    total = sum(x for d, x in parts if not d) + MISSPELT * max((x for d, x in parts if d), default=0.0)
    return 1 / (1 + math.exp(-min(50.0, max(-50.0, model["prior"] + total))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, toxic: float = TOXIC) -> DataFrame:
    """The columns of ``docs`` with held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Learns from ``fit_rows`` labelled documents at most, none of them held out. Only the
    text is scored. Null and empty texts, and all texts where no toxic one is labelled,
    get the prior alone. Repeated rows and null ids stay; columns of ``docs`` that are
    named like the three new ones are replaced. An empty table gives no rows.
    """
    model = train(docs, labels, fit_rows)
    key = f"toxicity:{sorted(model['entries'].items())}{sorted(model['kin'].items())}{model['prior']}"

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        matcher = per_process(key, lambda: Matcher(sorted(model["entries"]), model["entries"]))
        return pd.Series(np.array([evidence(matcher.best(t or ""), model) for t in texts], np.float64))

    return (docs.withColumn("held_out", split_of(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1])
            .withColumn("score", score(F.col("text"))).withColumn("predicted", (F.col("score") >= toxic).cast("int")))
