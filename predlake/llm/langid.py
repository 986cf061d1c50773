"""Language ID: interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

Counting reads every learning text in tasks: each task sends its distinct character
n-grams of the highest order with their counts, Spark adds them up, and all lower
orders follow from the distinct ones (Kneser-Ney's continuation counts). Each order
has the discount n1 / (n1 + 2 n2) of its language. A language's model is two kinds of
entry, both under 64-bit hashes in one sorted array: an n-gram's discounted share of
its context, and a context's weight of the next lower order:

    p(w | h) = max(c(hw) - D, 0) / c(h) + D types(h) / c(h) * p(w | h')

A text's cross-entropy is the mean over its positions, letters in lower case and
everything else as single spaces; the language of the least one is taken.

What is broadcast is bounded: a pass holds ENTRIES_PER_PASS entries at most. A larger
model is dealt by a hash of the last two characters of the context, and each pass adds
what the positions of its share give; orders 1 and 2 are in every pass. So results are
the same in one pass or many, and no text is ever shuffled.

Rejection: a twentieth of the learning texts is left out of the counts (of languages with 200 or more). From a bounded
sample of them, whole and in short cuts, come a logistic curve from the lead over the
second language to the probability of being right (``score``), the least score whose
predictions are PRECISION right, and for each language how far its own texts lie above
their mean entropy. ``rejected`` marks texts beyond either.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, materialise, per_process, split_of

ORDER = 5
PAD = "\n"                       # before a text; texts hold letters and spaces only
PIECE = 1 << 20                  # positions looked at together
FLUSH = 400_000                  # distinct n-grams that a counting task holds before it sends them on
KNOWN = 1_000_000                # n-grams whose costs a worker remembers at most
ENTRIES_PER_PASS = 4_000_000     # of 16 bytes, in one broadcast
HELD = 20                        # one learning text of so many calibrates
CALIBRATION_ROWS = 2_000         # sample bound: texts that calibrate at most, each also in cuts of CUTS characters
CUTS = (12, 40)
PRECISION = 0.99
UNKNOWN = "und"
SEED, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def letters(text: str) -> str:
    """Letters in lower case, every run of other characters as one space, none at the ends."""
    low = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    if low and not low.replace(" ", "").isalpha():  # signs such as one half count as word characters, not as letters
        low = " ".join("".join(c if c.isalpha() else " " for c in low).split())
    return low


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEP
    return x ^ (x >> np.uint64(29))


def ids(points: np.ndarray, context: bool) -> np.ndarray:
    """64-bit hashes of n-grams, or of contexts, given as rows of code points."""
    h = np.full(len(points), 2 * points.shape[1] + context, np.uint64) * SEED
    for j in range(points.shape[1]):
        h = mixed((h + points[:, j].astype(np.uint64)) * SEED)
    return h


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def blocks(texts):
    """(owner of each position, last place of each n-gram, code points) of padded texts, PIECE positions or somewhat more at a time."""
    held, owners, size = [], [], 0
    for owner, text in enumerate(texts):
        if not text:
            continue
        whole = PAD * (ORDER - 1) + text + " "
        for at in range(0, len(whole) - ORDER + 1, PIECE):
            part = whole[at:at + PIECE + ORDER - 1]
            held.append(part)
            owners.append(owner)
            size += len(part)
            if size >= PIECE:
                yield _block(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield _block(held, owners)


def _block(parts: list[str], owners: list[int]):
    sizes = np.array([len(p) for p in parts])
    points = points_of("".join(parts))
    inner = np.ones(len(points), bool)
    inner[np.add.outer(np.arange(ORDER - 1), np.cumsum(sizes) - sizes).ravel()] = False
    last = np.flatnonzero(inner)
    return np.repeat(owners, sizes - ORDER + 1), last, points


def distinct(last: np.ndarray, points: np.ndarray):
    """The distinct n-grams that end at ``last``: their hashes in order, code points in rows, and which of them each place has."""
    wide = points.astype(np.uint64)
    n = len(points) - ORDER + 1
    rolled = np.zeros(n, np.uint64)
    for j in range(ORDER):
        rolled = (rolled + wide[j:j + n]) * SEED
        rolled ^= rolled >> np.uint64(29)
    hashes, first, which = np.unique(rolled[last - ORDER + 1], return_index=True, return_inverse=True)
    return hashes, points[last[first][:, None] - np.arange(ORDER - 1, -1, -1)], which


class Tally:
    """Counts of n-grams by hash, merged now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, hashes: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((hashes, grams, counts))
        self.size += len(hashes)
        if self.size > 2 * FLUSH:
            self.merge()

    def merge(self) -> None:
        hashes, grams, counts = (np.concatenate(x) for x in zip(*self.parts))
        hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.parts = [(hashes, grams[first], np.bincount(which, counts, len(hashes)).astype(np.int64))]
        self.size = len(hashes)

    def rows(self, lang: str) -> pd.DataFrame:
        self.merge()
        _, grams, counts = self.parts.pop()
        self.size = 0
        text = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return pd.DataFrame({"lang": lang, "gram": [text[i:i + ORDER] for i in range(0, len(text), ORDER)], "n": counts})


def _count(batches):
    tallies: dict[str, Tally] = {}
    for pdf in batches:
        for lang, part in pdf.groupby("lang"):
            tally = tallies.setdefault(lang, Tally())
            for _, last, points in blocks([letters(t) for t in part.text]):
                hashes, grams, which = distinct(last, points)
                tally.add(hashes, grams, np.bincount(which))
            if sum(t.size for t in tallies.values()) > FLUSH:
                for t in tallies.values():
                    if t.parts:
                        t.merge()
                if sum(t.size for t in tallies.values()) > FLUSH:
                    yield from (t.rows(x) for x, t in tallies.items() if t.parts)
    yield from (t.rows(x) for x, t in tallies.items() if t.parts)


def _share(pair: np.ndarray, shares: int) -> np.ndarray:
    return (ids(pair, True) % np.uint64(shares)).astype(np.int64)


def _hashed(shares: int):
    """(lang, text, is it a context, value) -> (lang, share, id, value); a share of -1 belongs to every pass."""
    def run(batches):
        for pdf in batches:
            for (size, context), part in pdf.groupby([pdf.text.str.len(), "context"]):
                points = points_of("".join(part.text)).reshape(len(part), size)
                known = points if context else points[:, :-1]
                share = _share(known[:, -2:], shares) if known.shape[1] >= 2 else np.full(len(part), -1)
                yield pd.DataFrame({"lang": part.lang.values, "share": share, "id": ids(points, context).view(np.int64), "value": part.value.values})
    return run


@dataclass
class Models:
    """Languages in order, the size of the alphabet, the entries' table and its number of passes; calibration."""

    langs: list[str]
    alphabet: int
    entries: DataFrame | None
    passes: int
    slope: float = 4.0
    shift: float = 0.0
    least: float = 0.0
    usual: dict = field(default_factory=dict)  # language -> (mean entropy, allowed excess times the root of the length)


def count_grams(learn: DataFrame) -> DataFrame:
    """(lang, gram, c): n-grams of the highest order over all texts."""
    return (learn.select("lang", "text").mapInPandas(_count, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("c")))


def shares_of(grams: DataFrame) -> DataFrame:
    """(lang, gram, context, direct, weight) of every order, from the counts of the highest one."""
    suffixes = grams.select("lang", F.explode(F.array(*[F.substring("gram", -k, k) for k in range(1, ORDER + 1)])).alias("gram")).distinct()
    lower = suffixes.where(F.length("gram") > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("c"))
    context = Window.partitionBy("lang", "context")
    counted = (grams.unionByName(lower).withColumn("k", F.length("gram")).withColumn("context", F.expr("substring(gram, 1, k - 1)"))
               .withColumn("total", F.sum("c").over(context)).withColumn("types", F.count("*").over(context)))
    counted = materialise(counted, "counted")
    once, twice = F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))
    discounts = counted.groupBy("lang", "k").agg(F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("d"))
    return (counted.join(discounts, ["lang", "k"])
            .select("lang", "gram", "context", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("direct"),
                    (F.col("d") * F.col("types") / F.col("total")).alias("weight")))


def fit(learn: DataFrame, entries_per_pass: int = ENTRIES_PER_PASS) -> Models:
    """Models of ``learn`` (text, lang; neither null), every text counted or, one in HELD, kept for calibration.

    A language with fewer than ten texts to keep counts them all.
    """
    rare = [r["lang"] for r in learn.groupBy("lang").count().where(F.col("count") < 10 * HELD).collect()]
    held = (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0) & ~F.col("lang").isin(rare)
    grams = materialise(count_grams(learn.where(~held)), "grams")
    langs = [r["lang"] for r in grams.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return Models([], 1, None, 0)
    shares = materialise(shares_of(grams), "shares")
    rows = shares.agg(F.count("*"), F.count_distinct(F.when(F.length("gram") == 1, F.col("gram")))).first()
    passes = -(-2 * rows[0] // entries_per_pass)  # an n-gram has one entry, and its context one more at most
    entries = (shares.select("lang", F.col("gram").alias("text"), F.lit(False).alias("context"), F.col("direct").alias("value"))
               .unionByName(shares.groupBy("lang", F.col("context").alias("text")).agg(F.max("weight").alias("value")).withColumn("context", F.lit(True))))
    models = Models(langs, rows[1] + 1, materialise(entries.mapInPandas(_hashed(passes), "lang string, share long, id long, value double"), "entries"), passes)
    calibrate(models, learn.where(held))
    return models


def arrays(models: Models, number: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted ids, values) of each language in one pass."""
    rows = models.entries.where(F.col("share").isin(-1, number)).select("lang", "id", "value").toArrow()
    lang = np.array(rows.column("lang").to_pylist(), dtype=object)
    entry, value = rows.column("id").to_numpy().view(np.uint64), rows.column("value").to_numpy().astype(np.float32)
    out = []
    for name in models.langs:
        mine = np.flatnonzero(lang == name)
        mine = mine[np.argsort(entry[mine], kind="stable")]
        out.append((entry[mine], value[mine]))
    return out


def found(model: tuple[np.ndarray, np.ndarray], wanted: np.ndarray, missing: float) -> np.ndarray:
    keys, values = model
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at].astype(np.float64), missing)


def bits(grams: np.ndarray, model, alphabet: int) -> np.ndarray:
    """-log2 of the interpolated probability of each n-gram's last character."""
    p = np.full(len(grams), 1.0 / alphabet)
    for k in range(1, ORDER + 1):
        part = grams[:, ORDER - k:]
        p = found(model, ids(part, False), 0.0) + found(model, ids(part[:, :-1], True), 1.0) * p
    return -np.log2(p)


class Costs:
    """Costs of n-grams in all languages; those of the last KNOWN distinct ones are remembered."""

    def __init__(self, model: list, alphabet: int) -> None:
        self.model, self.alphabet = model, alphabet
        self.keys, self.costs = np.zeros(0, np.uint64), np.zeros((0, len(model)))

    def of(self, hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Rows of costs, for sorted distinct hashes."""
        out = np.empty((len(hashes), len(self.model)))
        at = np.searchsorted(self.keys, hashes)
        old = np.zeros(len(hashes), bool)
        inside = at < len(self.keys)
        old[inside] = self.keys[at[inside]] == hashes[inside]
        out[old] = self.costs[at[old]]
        new = np.flatnonzero(~old)
        if len(new):
            for i, one in enumerate(self.model):
                out[new, i] = bits(grams[new], one, self.alphabet)
            if len(self.keys) + len(new) > KNOWN:
                self.keys, self.costs = hashes, out
            else:
                self.keys, self.costs = np.insert(self.keys, at[new], hashes[new]), np.insert(self.costs, at[new], out[new], axis=0)
        return out


def _scorer(models: Models, number: int):
    """Adds one pass to the entropies: (text, sums so far) -> sums of all languages, and the number of positions."""
    spark_model = models.entries.sparkSession.sparkContext.broadcast(arrays(models, number))
    alphabet, passes, key = models.alphabet, models.passes, f"langid:{uuid.uuid4().hex}"

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series, before: pd.Series) -> pd.Series:
        costs = per_process(key, lambda: Costs(spark_model.value, alphabet))
        n = len(costs.model)
        low = [letters(t or "") for t in texts]
        sums = np.array([np.zeros(n + 1) if b is None else b for b in before]).reshape(len(texts), n + 1)
        sums[:, n] = [len(t) + 1 if t else 0 for t in low]
        for owner, last, points in blocks(low):
            hashes, grams, which = distinct(last, points)
            cost = costs.of(hashes, grams)
            if passes > 1:
                cost = np.where((_share(grams[:, -3:-1], passes) == number)[:, None], cost, 0.0)
            for i in range(n):
                sums[:, i] += np.bincount(owner, cost[:, i][which], len(texts))
        return pd.Series(list(sums))

    return run


def entropies(df: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """``df`` with _bits (of each language, by language) and _positions, the number of characters they are summed over."""
    df = df.withColumn("_bits", F.lit(None).cast("array<double>"))
    for number in range(models.passes):
        df = df.withColumn("_bits", _scorer(models, number)(F.col(text_col), F.col("_bits")))
        if number + 1 < models.passes:
            df = materialise(df, "entropies")  # one model at a time in a worker
    n = len(models.langs)
    return df.withColumn("_positions", F.get("_bits", F.lit(n)).cast("long")).withColumn("_bits", F.slice("_bits", 1, n))


def judged(df: DataFrame, models: Models) -> DataFrame:
    """Adds _lang, _entropy and _lead, the second-best entropy's distance (an even guess stands in for a second language)."""
    least = F.array_min("_bits")
    second = F.get(F.sort_array("_bits"), F.lit(1)) if len(models.langs) > 1 else F.col("_positions") * float(np.log2(models.alphabet))
    names = F.array(*[F.lit(x) for x in models.langs])
    some = F.col("_positions") > 0
    return (df.withColumn("_lang", F.when(some, F.get(names, (F.array_position("_bits", least) - 1).cast("int"))))
            .withColumn("_entropy", F.when(some, least / F.col("_positions")))
            .withColumn("_lead", F.when(some, (second - least) / F.sqrt("_positions"))))


def calibrate(models: Models, held: DataFrame) -> None:
    """Score curve, least score and usual entropies from a bounded sample of texts that were not counted."""
    sample = bounded_sample(held.select("lang", "text").distinct(), ["text", "lang"], CALIBRATION_ROWS)
    place = F.pmod(F.xxhash64("lang", "text"), F.greatest(F.length("text"), F.lit(1))).cast("int")
    cuts = F.array(F.col("text"), *[F.substring(F.col("text"), place + 1, F.lit(n)) for n in CUTS])
    scored = judged(entropies(sample.select("lang", F.posexplode(cuts).alias("cut", "text")), models), models)
    rows = scored.where(F.col("_positions") > 0).select("lang", "cut", "_lang", "_entropy", "_lead", "_positions").toPandas()
    if rows.empty:
        return
    right = (rows.lang == rows._lang).to_numpy(float)
    lead, scale = rows._lead.to_numpy(), 1.0
    a, b = models.slope, models.shift
    for _ in range(25):  # regularised Newton steps
        p = 1 / (1 + np.exp(-np.clip(a * lead + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - right) * lead).sum() + scale * (a - 4.0), (p - right).sum() + scale * b])
        h = np.array([[(w * lead * lead).sum() + scale, (w * lead).sum()], [(w * lead).sum(), w.sum() + scale]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -2, 2)
    models.slope, models.shift = float(max(a, 0.0)), float(b)
    p = 1 / (1 + np.exp(-np.clip(models.slope * lead + models.shift, -30, 30)))
    order = np.argsort(-p, kind="stable")
    precise = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * np.arange(1, len(p) + 1))
    models.least = float(p[order][precise[-1]]) if len(precise) else 1.0
    for name, own in rows[rows.lang == rows._lang].groupby("lang"):
        mean = float(own._entropy[own.cut == 0].mean()) if (own.cut == 0).any() else float(own._entropy.mean())
        models.usual[name] = (mean, float(np.quantile((own._entropy - mean) * np.sqrt(own._positions), 0.995)))
    widest = tuple(map(max, zip(*models.usual.values())))
    if widest:  # for languages without texts of their own in the sample
        models.usual = {name: models.usual.get(name, widest) for name in models.langs}


def identify(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with lang_pred, score, cross_entropy (bits a character) and rejected.

    Each row is read alone, so repeated rows and null ids stay as they are. A null text, an empty
    one and one without a letter are UNKNOWN with score 0, without an entropy, and rejected; so is
    every text if nothing was learned. Of languages with equal entropies the first by name is taken.
    ``rejected`` says that the language taken is doubtful; it is still given. Columns named like the
    new ones are replaced. An empty table gives none.
    """
    new = ["lang_pred", "score", "cross_entropy", "rejected"]
    kept = docs.drop(*new)
    if not models.langs:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "rejected": F.lit(True)})
    out = judged(entropies(kept, models, text_col), models)
    score = 1 / (1 + F.exp(-(F.lit(models.slope) * F.col("_lead") + models.shift)))
    limits = F.lit(False)
    for name, (mean, excess) in models.usual.items():
        limits = F.when(F.col("_lang") == name, (F.col("_entropy") - mean) * F.sqrt("_positions") > excess).otherwise(limits)
    return (out.withColumn("lang_pred", F.coalesce("_lang", F.lit(UNKNOWN))).withColumn("score", F.when(F.col("_lang").isNull(), 0.0).otherwise(score))
            .withColumn("cross_entropy", F.col("_entropy")).withColumn("rejected", F.col("_lang").isNull() | (F.col("score") < models.least) | limits)
            .drop("_bits", "_positions", "_lang", "_entropy", "_lead"))


def language_scores(docs: DataFrame, held_out: int = 2, modulus: int = 4, entries_per_pass: int = ENTRIES_PER_PASS) -> DataFrame:
    """``docs`` (doc_id, text, lang) with held_out and the columns of ``identify``, learned from the rows that are not held out and have a lang.

    A null doc_id counts as the empty text in the split. Copies of a text are counted as often as they stand there.
    """
    split = split_of(F.col("doc_id"), modulus) == held_out
    learn = docs.where(~split & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    return identify(docs, fit(learn, entries_per_pass)).withColumn("held_out", split)
