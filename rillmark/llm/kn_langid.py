"""Language identification with interpolated Kneser-Ney character models.

Training counts character n-grams of labelled texts in Spark. Each language's model is then a set of sorted arrays of
n-gram hashes with discounted probabilities and back-off weights; the arrays of all languages are aligned on the union
of their n-grams, so one binary search scores a character for every language. The lowest cross-entropy per character
wins. Both the score and the rejection are calibrated on labelled texts that the model used has not seen: the score is the
probability that the language is right, by a logistic curve over the gap to the second language and the number of
letters; a text is rejected if its cross-entropy is above the limit of its language and length. A limit lies a number of
spreads above the median, a spread being the way from the median to the USUAL quantile; the number is the least that
FALSE of the correctly identified texts exceed, but within MARGINS, so that odd texts among the labelled ones, even a
tenth, do not lift the limits to themselves.

The training sample is bounded: about `sample_docs` documents a language, chosen by a hash of id and text; whole texts.
A language with fewer than twice as many has no others to calibrate on: its sample (all of it, up to the bound) is fitted
as a whole, and each half of it is calibrated with a model fitted on the other half. What is collected is bounded by
that sample and the number of languages: its n-grams, and four numbers a calibration text.

Defined results: a null text or one without letters is `und` with score 0 and is rejected; case, digits and punctuation
do not count; rows with a null language or text train nothing; an empty table, or one without labels, gives `und` for
every row, and nothing with letters is rejected; texts count as a whole, however long; repeated rows get equal results;
of languages that are equally likely the first in order wins; only the columns named are read or kept as they are, so
others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name
from .vectors import mix

ORDER = 4
#: The share of correctly identified texts that may be rejected; the quantile that tells the spread, and the least and most spreads of a limit.
FALSE, USUAL, MARGINS = 0.002, 0.9, (4.0, 12.0)
#: Classes of length by powers of four letters; one with fewer calibration texts takes those of its neighbours, too.
CLASSES, ENOUGH = 9, 200
#: Characters that keep_accepted() scores at once, as its workers hold two models beside.
CHUNK = 100_000
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point its lower-case form, or 0 where it is no letter."""
    if "letters" not in _tables:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x20000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        out[0x20000:0x32000] = np.arange(0x20000, 0x32000)  # ideographs, which have no case
        _tables["letters"] = out
    return _tables["letters"]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): letters in lower case with runs of anything else as one 0, each text led by ORDER - 1 zeros."""
    lead = "\0" * (ORDER - 1)
    joined = lead + lead.join(f"{t or ''}\0" for t in texts)
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t or "") + ORDER for t in texts])
    ends = np.cumsum(sizes)
    codes = _letters()[raw]
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0  # the first of a run of others stays as the word's end
    starts = ends - sizes
    for j in range(ORDER - 1):
        keep[starts + j] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], at[np.concatenate([[0], ends])]


def gram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n symbols that end at each position (positions below n - 1 are not used)."""
    out = np.zeros(len(codes), np.uint64)
    for j in range(n - 1, -1, -1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[j:] = codes[: len(codes) - j]
        out = out * np.uint64(0x100000001B3) + shifted + np.uint64(1)
    return mix(out)


def _scored(offsets: np.ndarray) -> np.ndarray:
    """Positions that count: all but each text's lead."""
    n = np.diff(offsets)
    skip = np.minimum(n, ORDER - 1)
    k = n - skip
    return np.repeat(offsets[:-1] + skip - (np.cumsum(k) - k), k) + np.arange(k.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            step, total = [], 0
            for i, t in enumerate(mine):
                step.append(t)
                total += len(t or "")
                if total < 1_000_000 and i + 1 < len(mine):
                    continue
                codes, offsets = symbols(step)
                at = _scored(offsets)
                full = gram_codes(codes, ORDER)[at]
                keys, first, n = np.unique(full, return_index=True, return_counts=True)
                where = at[first]
                grams = np.stack([codes[where - j] for j in range(ORDER - 1, -1, -1)], 1).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "key": keys.view(np.int64), "gram": list(grams), "n": n.astype(np.int64)}, schema=pa.schema([("lang", pa.string()), ("key", pa.int64()), ("gram", pa.list_(pa.int32())), ("n", pa.int64())]))
                step, total = [], 0


class Model:
    """Sorted hash arrays: keys[n] of the n-grams seen in any language; logp[n] (grams x languages) of the last symbol,
    -inf where a language has not seen the gram; back[n] the log weight of what it leaves to the shorter context."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.keys: dict[int, np.ndarray] = {}
        self.logp: dict[int, np.ndarray] = {}
        self.back: dict[int, np.ndarray] = {}
        self.floor = np.log(1 / 200_000)
        self.limits = np.full((len(langs), CLASSES), np.inf)
        self.curve = np.array([0.0, 8.0, 0.5])  # of the score
        self.others: dict[int, Model] = {}  # for each half of the texts, a model that has seen none of it

    def score(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability under each language of the symbol at each of the positions."""
        keys, inverse = np.unique(gram_codes(codes, ORDER)[at], return_inverse=True)
        first = np.zeros(len(keys), np.int64)
        first[inverse] = at
        return self._lookup(codes, first, ORDER, keys)[inverse]

    def _lookup(self, codes: np.ndarray, at: np.ndarray, n: int, keys: np.ndarray | None = None) -> np.ndarray:
        if n == 0:
            return np.full((len(at), len(self.langs)), self.floor)
        if keys is None:
            keys = _hash_at(codes, at, n)
        out, _ = _get(self.keys[n], self.logp[n], keys, -np.inf)
        todo = np.flatnonzero(~np.isfinite(out).all(1))
        if len(todo):
            lower = self._lookup(codes, at[todo], n - 1)
            context = _hash_at(codes, at[todo] - 1, n - 1) if n > 1 else np.zeros(len(todo), np.uint64)
            weight, _ = _get(self.keys.get(-n, np.zeros(0, np.uint64)), self.back[n], context, 0.0)
            out[todo] = np.where(np.isfinite(out[todo]), out[todo], weight + lower)
        return out


def _hash_at(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(n - 1, -1, -1):
        out = out * np.uint64(0x100000001B3) + codes[at - j].astype(np.uint64) + np.uint64(1)
    return mix(out)


def _get(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), default), np.zeros(len(wanted), bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[i] == wanted
    return np.where(hit[:, None], values[i], default), hit


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Kneser-Ney models from each language's (grams x ORDER symbols, counts)."""
    langs = sorted(counts)
    model = Model(langs)
    per: dict[int, list] = {n: [] for n in range(1, ORDER + 1)}
    for lang in langs:
        grams, n = counts[lang]
        levels = {ORDER: (grams, n.astype(float))}
        for k in range(ORDER - 1, 0, -1):  # continuation counts: how many symbols precede the shorter gram
            longer = levels[k + 1][0]
            shorter, c = np.unique(longer[:, 1:], axis=0, return_counts=True)
            levels[k] = (shorter, c.astype(float))
        lower = None
        for k in range(1, ORDER + 1):
            g, c = levels[k]
            once, twice = (c == 1).sum(), (c == 2).sum()
            d = once / (once + 2 * twice) if once and twice else 0.5
            h = _rows_hash(g[:, :-1]) if k > 1 else np.zeros(len(g), np.uint64)
            heads, inv = np.unique(h, return_inverse=True)
            total, kinds = np.bincount(inv, c), np.bincount(inv)
            back = d * kinds / total
            if k == 1:
                base = np.full(len(g), 1 / 200_000)
            else:
                keys, probs = lower
                base = probs[np.searchsorted(keys, _rows_hash(g[:, 1:]))]
            p = (c - d) / total[inv] + back[inv] * base
            keys = _rows_hash(g)
            order = np.argsort(keys)
            lower = (keys[order], p[order])
            per[k].append((keys[order], np.log(p[order]), heads, np.log(back)))
    for k in range(1, ORDER + 1):
        for name, (a, b), default in (("p", (0, 1), -np.inf), ("b", (2, 3), 0.0)):
            keys = np.unique(np.concatenate([x[a] for x in per[k]]))
            table = np.full((len(keys), len(langs)), default, np.float32)
            for j, x in enumerate(per[k]):
                table[np.searchsorted(keys, x[a]), j] = x[b]
            if name == "p":
                model.keys[k], model.logp[k] = keys, table
            else:
                model.keys[-k], model.back[k] = keys, table
    return model


def _rows_hash(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for j in range(grams.shape[1]):
        out = out * np.uint64(0x100000001B3) + grams[:, j].astype(np.uint64) + np.uint64(1)
    return mix(out)


def entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy per symbol of each text and language, letters of each text)."""
    codes, offsets = symbols(texts)
    at = _scored(offsets)
    n = np.maximum(np.diff(offsets) - (ORDER - 1), 0)
    out = np.zeros((len(texts), len(model.langs)))
    if len(at):
        got = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(model.score(codes, at), 0, dtype=float)])
        ends = np.cumsum(n)
        out = -(got[ends] - got[ends - n]) / np.maximum(n, 1)[:, None]
    letters = np.concatenate([[0], np.cumsum(codes > 0)])
    return out, letters[offsets[1:]] - letters[offsets[:-1]]


def letter_counts(texts: list[str | None]) -> np.ndarray:
    codes, offsets = symbols(texts)
    letters = np.concatenate([[0], np.cumsum(codes > 0)])
    return letters[offsets[1:]] - letters[offsets[:-1]]


def _class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)) / 2, CLASSES - 1).astype(np.int64)


def _gap(e: np.ndarray) -> np.ndarray:
    """How far the second language is behind the first."""
    return np.diff(np.partition(e, 1, axis=1)[:, :2], axis=1)[:, 0] if e.shape[1] > 1 else np.ones(len(e))


def _traits(gap: np.ndarray, letters: np.ndarray) -> np.ndarray:
    size = np.log1p(letters)
    return np.stack([np.ones(len(gap)), gap, gap * size], 1)


def fit_curve(gap: np.ndarray, letters: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve, by Newton's method with smoothed targets: without errors it is not certain either."""
    x = _traits(gap, letters)
    yes, no = good.sum(), (~good).sum()
    y = np.where(good, (yes + 1) / (yes + 2), 1 / (no + 2))
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def confidence(model: Model, e: np.ndarray, letters: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_traits(_gap(e), letters) @ model.curve, -30, 30)))


def limits(told: np.ndarray, best: np.ndarray, letters: np.ndarray, langs: int) -> np.ndarray:
    """The limit of each language and class of length, from correctly identified texts; the loosest one where there are none."""
    middle, spread = np.full((langs, CLASSES), np.nan), np.full((langs, CLASSES), np.nan)
    size = _class(letters)
    for k in range(langs):
        for c in range(CLASSES):
            reach = 0
            while True:
                x = best[(told == k) & (abs(size - c) <= reach)]
                if len(x) >= ENOUGH or reach == CLASSES:
                    break
                reach += 1
            if len(x):
                middle[k, c], far = np.quantile(x, [0.5, USUAL])
                spread[k, c] = max(far - middle[k, c], 0.02 * middle[k, c])
    if not len(best):
        return np.full((langs, CLASSES), np.inf)
    margin = np.clip(np.quantile((best - middle[told, size]) / spread[told, size], 1 - FALSE), *MARGINS)
    out = middle + margin * spread
    return np.where(np.isnan(out), np.nanmax(out), out)


def rejected(model: Model | None, e: np.ndarray, letters: np.ndarray) -> np.ndarray:
    none = letters == 0
    return none if model is None else none | (e.min(1) > model.limits[e.argmin(1), _class(letters)])


def _half(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col, "text", F.lit(2)), F.lit(2)).cast("int")


def train(docs: DataFrame, eligible: Column, sample_docs: int = 1500, id_col: str = "doc_id", crossed: bool = False) -> Model | None:
    """Fit on about sample_docs labelled documents a language among the eligible, calibrate on about as many others.

    crossed: all languages are calibrated by halves, and the model keeps that of each half for keep_accepted().
    """
    draw, half = F.pmod(F.xxhash64(id_col, "text"), F.lit(1 << 30)), _half(id_col)
    labelled = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", draw.alias("draw"), half.alias("half"))
    sizes = labelled.groupBy("lang").count().collect()  # one row a language
    if not sizes:
        return None
    share = F.coalesce(*(F.when(F.col("lang") == r.lang, F.lit(min(1 << 30, int((1 << 30) * sample_docs / r["count"])))) for r in sizes))
    few = F.lit(True) if crossed else F.col("lang").isin([r.lang for r in sizes if r["count"] < 2 * sample_docs])
    # fold: the half of a language with few documents, 2 for the sample of another one, 3 for what calibrates it.
    part = labelled.where(F.col("draw") < F.when(few, share).otherwise(2 * share))
    part = part.withColumn("fold", F.when(few, F.col("half")).when(F.col("draw") < share, 2).otherwise(3))
    grams = (
        part.where("fold < 3").select(F.concat(F.col("fold").cast("string"), "lang").alias("lang"), "text")
        .mapInArrow(_count, "lang string, key long, gram array<int>, n long")
        .groupBy("lang", "key").agg(F.first("gram").alias("gram"), F.sum("n").alias("n"))
        .orderBy("lang", "key").toArrow()
    )  # the n-grams of the bounded sample
    if not len(grams):
        return None
    named = np.array(grams.column("lang").to_pylist(), object)
    flat = grams.column("gram").combine_chunks().values.to_numpy().reshape(-1, ORDER)
    n = grams.column("n").to_numpy()
    found = {x: (flat[named == x], n[named == x]) for x in sorted(set(named))}

    def fitted(folds: str) -> Model | None:
        langs = sorted({name[1:] for name in found if name[0] in folds})
        return build({x: _summed([v for name, v in found.items() if name[1:] == x and name[0] in folds]) for x in langs}) if langs else None

    model = fitted("012")
    # Texts of half 0 are measured by the model without it, and so on; without halves all models are the same.
    others = {0: fitted("12"), 1: fitted("02")} if any(x[0] in "01" for x in found) else {}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for marks, texts in zip(*_chunks(batch), strict=True):
                for fold in sorted({x[0] for x in marks}):
                    used = others.get(int(fold), model)
                    mine = [i for i, x in enumerate(marks) if x[0] == fold]
                    if not used:  # the other half has no text
                        continue
                    e, letters = entropies(used, [texts[i] for i in mine])
                    told = np.array([used.langs[k] for k in e.argmin(1)], object)
                    right = told == np.array([marks[i][1:] for i in mine], object)
                    ok = letters > 0
                    yield pa.RecordBatch.from_pydict({"told": pa.array(told[ok], pa.string()), "best": e.min(1)[ok], "gap": _gap(e)[ok], "letters": letters[ok].astype(np.int64), "good": right[ok]})

    seen = part.where("fold <> 2").select(F.concat(F.col("fold").cast("string"), "lang").alias("mark"), "text")
    seen = seen.mapInArrow(measure, "told string, best double, gap double, letters long, good boolean").toArrow()  # the bounded sample
    if len(seen):
        told = np.array([model.langs.index(x) for x in seen.column("told").to_pylist()])
        best, gap, letters, good = (seen.column(c).to_numpy() for c in ("best", "gap", "letters", "good"))
        model.limits = limits(told[good], best[good], letters[good], len(model.langs))
        model.curve = fit_curve(gap, letters, good)
    if crossed:
        for of, other in others.items():
            if other is not None:  # the limits of the languages that it knows
                other.limits = model.limits[[model.langs.index(x) for x in other.langs]]
                model.others[of] = other
    return model


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One table of distinct n-grams and their counts."""
    if len(parts) == 1:
        return parts[0]
    grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), axis=0, return_inverse=True)
    return grams, np.bincount(inverse.ravel(), np.concatenate([n for _, n in parts])).astype(np.int64)


def _chunks(batch: pa.RecordBatch, most: int = 400_000) -> tuple[list, list]:
    firsts, texts = batch.column(0).to_pylist(), batch.column("text").to_pylist()
    a, size, cut = 0, 0, []
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > most or i + 1 == len(texts):
            cut.append((a, i + 1))
            a, size = i + 1, 0
    return [firsts[x:y] for x, y in cut], [texts[x:y] for x, y in cut]


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every text."""
    schema = "id long, lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in zip(*_chunks(batch), strict=True):
                e, letters = entropies(model, texts) if model else (np.zeros((len(texts), 1)), letter_counts(texts))
                none = letters == 0
                best = e.argmin(1)
                score = np.where(none, 0.0, confidence(model, e, letters)) if model else np.zeros(len(texts))
                reject = rejected(model, e, letters)
                pred = [("und" if x else model.langs[k]) for x, k in zip(none | (model is None), best, strict=True)]
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "lang_pred": pred, "score": score, "rejected": reject})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text is accepted by a language model that was not fitted on it; one pass, no shuffle."""
    half_col = free_name(docs, "half")
    rows = docs.withColumn(half_col, _half(id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            at, half = 0, batch.column(half_col).to_numpy()
            texts = batch.column(text_col)
            for part in _chunks(pa.RecordBatch.from_arrays([texts, texts], names=["first", "text"]), CHUNK)[1]:
                for h in (0, 1):
                    mine = np.flatnonzero(half[at : at + len(part)] == h)
                    if len(mine):
                        some = [part[i] for i in mine]
                        used = model.others.get(h, model) if model else None
                        e, letters = entropies(used, some) if used else (None, letter_counts(some))
                        keep[at + mine] = ~rejected(used, e, letters)
                at += len(part)
            yield batch.drop_columns([half_col]).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)
