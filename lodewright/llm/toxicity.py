"""Toxicity of whole texts by a support vector machine on a subsequence string kernel.

Two strings are alike by the subsequences of ``LENGTH`` characters that they share, each weighted by ``DECAY``
to the power of the stretches it spans, so characters put between those of an insult lower its likeness but
don't undo it. Landmark strings (Nyström) turn the kernel into a few numbers per string, on which a linear
machine is trained. Labels are given for texts only: a text's insult is taken to be the unit that the machine
finds worst, and the machine is trained again on those units. A text scores as its worst unit.

A unit is a word (without punctuation at its ends), a word's letters without the other characters, a run of single characters with blanks between, or a part
of ``UNIT`` characters of a longer word, each part overlapping the next by half.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import written

LENGTH = 5
DECAY = 0.85
# Stands before a unit's first character: stems of words differ from the same letters inside a word.
BEGIN = "^"
UNIT = 32
GRAMS = (4, 5, 6)
LANDMARKS = 48
LANDMARK_CHARS = 9
# Least part of a landmark that the ones before it don't stand for.
NOVEL = 0.4
# Power of the normalised kernel, which sets chance likenesses further apart from real ones.
POWER = 2
# Labelled texts to train on, at most, those first by a hash of their id; the only bound on the training.
SAMPLE = 8_000
# Grams, and units of a text, that the driver gets.
KEPT_GRAMS = 4_000
WITNESSES = 5
# Rounds in which a text's worst unit is found and the machine trained on it.
ROUNDS = 6
CACHED_UNITS = 600_000
# Pairs that the kernel works on at once: their state fits a core's cache.
PAIRS = 4_096
# Least likelihood ratio of a gram that tells toxic from clean texts, against chance among many grams.
EVIDENCE = 25.0
# How much more frequent in toxic texts such a gram is at least.
LIFT = 5.0
THRESHOLD = 0.3

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»“”„‘’…–—"
_SPACED = re.compile(r"(?<![^ ])(?:[^ ] ){2,}[^ ](?![^ ])")


def units_of(words: list[str]) -> list[str]:
    """The units of words that white space parted."""
    out = []
    for word in words:
        word = word.strip(_EDGES)
        if len(word) <= UNIT:
            if len(word) > 1:
                out.append(BEGIN + word)
                plain = "" if word.isalnum() else "".join(filter(str.isalpha, word))
                if len(plain) > 1:
                    out.append(BEGIN + plain)
        else:
            out += [
                (BEGIN if i == 0 else "") + word[i : i + UNIT]
                for i in range(0, len(word) - UNIT // 2, UNIT // 2)
            ]
    return out


def spaced(text: str) -> list[str]:
    """Runs of three or more single characters, with and without blanks, as parts of a unit's size."""
    out = []
    for run in _SPACED.findall(" ".join(text.split())):
        letters = run.replace(" ", "")
        # The first character may be a word of its own.
        for whole in (run, letters, letters[1:]):
            out += [
                (BEGIN if i == 0 else "") + whole[i : i + UNIT]
                for i in range(0, max(1, len(whole) - UNIT // 2), UNIT // 2)
            ]
    return out


def _coded(strings: list[str], missing: int) -> np.ndarray:
    """The strings' characters, a row for each, filled up with ``missing``."""
    width = max(map(len, strings))
    flat = "".join([s.ljust(width, "\0") for s in strings]).encode("utf-32-le", "surrogatepass")
    out = np.frombuffer(flat, np.int32).reshape(-1, width).copy()
    out[np.arange(width) >= np.fromiter(map(len, strings), np.int64, len(strings))[:, None]] = missing
    return out


def subsequences(strings: list[str], others: list[str], both: np.ndarray | None = None) -> np.ndarray:
    """The gap-weighted kernel of each string with each other one (or of pairs, for ``both`` = pair rows)."""
    a, b = _coded(strings, -1), _coded(others, -2)
    right = b.shape[1]
    if both is None:
        rows, columns = (x.ravel() for x in np.indices((len(strings), len(others))))
    else:
        rows, columns = both
    out = np.zeros(len(rows), np.float32)
    decay, matched = np.float32(DECAY), np.float32(DECAY * DECAY)
    for first in range(0, len(rows), PAIRS):
        # A column per pair, so that every step works on long rows.
        s = np.ascontiguousarray(a[rows[first : first + PAIRS]].T)
        t = np.ascontiguousarray(b[columns[first : first + PAIRS]].T)
        number = s.shape[1]
        begun = np.zeros((LENGTH, right + 1, number), np.float32)
        begun[0] = 1
        total = np.zeros(number, np.float32)
        for i in range((s >= 0).any(axis=1).sum()):
            same = (s[i] == t) * matched
            for n in range(LENGTH - 1, -1, -1):
                step = same * begun[n, :-1]
                if n == LENGTH - 1:
                    total += step.sum(axis=0)
                    continue
                # What ends at each place of t, with the gaps since.
                for j in range(1, right):
                    step[j] += decay * step[j - 1]
                begun[n + 1] *= decay
                begun[n + 1, 1:] += step
        out[first : first + number] = total
    return out if both is not None else out.reshape(len(strings), len(others))


class Kernel:
    """Normalised likeness of units to landmarks, as features."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.own = self._self(landmarks)
        among = (subsequences(landmarks, landmarks) / np.sqrt(np.outer(self.own, self.own))) ** POWER
        value, vector = np.linalg.eigh(among + 1e-4 * np.eye(len(landmarks)))
        self.root = (vector / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
        self.letters = [set(mark) for mark in landmarks]
        every = sorted(set().union(*self.letters))
        self.bit = np.full(0x110000, len(every), np.int32)
        self.bit[[ord(c) for c in every]] = np.arange(len(every))
        self.marks = np.zeros((len(every), len(landmarks)), np.float32)
        for j, letters in enumerate(self.letters):
            self.marks[self.bit[[ord(c) for c in letters]], j] = 1

    @staticmethod
    def _self(strings: list[str]) -> np.ndarray:
        n = np.arange(len(strings))
        return np.maximum(subsequences(strings, strings, (n, n)), 1e-12)

    def features(self, units: list[str]) -> np.ndarray:
        out = np.zeros((len(units), len(self.landmarks)))
        order = np.argsort([len(unit) for unit in units], kind="stable")
        for part in np.array_split(order, max(1, len(order) // 4096)):
            chosen = [units[i] for i in part]
            # Units that share fewer letters with a landmark than a subsequence has aren't like it at all.
            masks = np.zeros((len(chosen), self.marks.shape[0] + 1), np.float32)
            masks[np.arange(len(chosen))[:, None], self.bit[_coded(chosen, 0)]] = 1
            need = np.minimum([len(x) for x in self.letters], LENGTH)
            masks = masks[:, :-1]
            pairs = np.nonzero((masks @ self.marks) >= np.maximum(need, 1))
            if len(pairs[0]):
                value = subsequences(chosen, self.landmarks, pairs)
                own = self._self(chosen)
                out[part[pairs[0]], pairs[1]] = (
                    value / np.sqrt(own[pairs[0]] * self.own[pairs[1]])
                ) ** POWER
        return out @ self.root


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, classes weighted alike."""
    x = np.hstack([x, np.ones((len(x), 1))])
    each = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum()))
    each *= cost * len(y) / 2
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * each[active, None]
        new = np.linalg.solve(ridge + x[active].T @ xa, xa.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


class Model:
    """What scores a unit, and turns a text's worst unit into a probability."""

    def __init__(self, kernel: Kernel | None, weights, offset: float):
        self.kernel, self.weights, self.offset = kernel, weights, offset
        self.slope, self.level = 1.0, 0.0
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def of_units(self, units: list[str]) -> np.ndarray:
        if self.kernel is None or not units:
            return np.full(len(units), -1.0)
        return self.kernel.features(units) @ self.weights + self.offset

    def worst(self, texts: pa.Array) -> np.ndarray:
        """The worst unit's value for each text; -1 without units."""
        lower = pc.utf8_lower(texts)
        words = pc.utf8_split_whitespace(lower)
        counts = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        value = self._of_words(coded.dictionary.to_pylist())
        out = np.full(len(texts), -1.0)
        owner = np.repeat(np.arange(len(texts)), counts)
        np.maximum.at(out, owner, value[coded.indices.to_numpy()] if len(value) else np.zeros(0))
        for i, text in enumerate(lower.to_pylist()):
            runs = spaced(text)
            if runs:
                out[i] = max(out[i], self.of_units(runs).max())
        return out

    def _of_words(self, words: list[str]) -> np.ndarray:
        if len(self.known) > CACHED_UNITS:
            self.known.clear()
        known = self.known
        new = sorted({word for word in words if word not in known}, key=len)
        split = [units_of([word]) for word in new]
        flat = sorted({unit for units in split for unit in units})
        of_unit = dict(zip(flat, self.of_units(flat).tolist()))
        known.update((w, max((of_unit[u] for u in units), default=-1.0)) for w, units in zip(new, split))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.level, -30, 30)))


def _text_units(text: str) -> set[str]:
    text = text.lower()
    return {*units_of(text.split()), *spaced(text)}


def _grams(unit: str) -> set[str]:
    return {unit[i : i + n] for n in GRAMS for i in range(len(unit) - n + 1)}


def _with_marks(units: list[str]) -> list[str]:
    """Each unit with characters put between its own, as those that hide insults do."""
    out = []
    for i, unit in enumerate(units):
        gap = "-.* _"[i % 5]
        word = unit.removeprefix(BEGIN)
        half = len(word) // 2
        out += [BEGIN + gap.join(word)[:UNIT], BEGIN + word[:half] + gap + word[half:]]
    return out


_BAGS = pa.schema([("toxic", pa.int32()), ("units", pa.list_(pa.string()))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the rows (doc_id, text) that (doc_id, toxic) labels and that aren't held out.

    ``sample`` bounds the documents it learns from, those first by a hash of their id, a quarter of them toxic if
    there are as many. Of several labels of a document the highest counts, of several texts the smallest;
    null ids and null labels take no part. Without toxic or without clean texts every score is the same.
    """
    marks = labels.where("doc_id is not null and toxic in (0, 1)")
    marks = marks.where(~held_out(F.col("doc_id"), 4, 2)).groupBy("doc_id")
    marks = marks.agg(F.max("toxic").cast("int").alias("toxic"))
    ordered = marks.orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = ordered.where("toxic = 1").limit(sample // 4)
    picked = picked.unionAll(ordered.where("toxic = 0").limit(sample - sample // 4))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # `sample` ids and labels at most, so they can go to every task.
    chosen = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id")
    chosen = chosen.agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    chosen = written(chosen.select("text", "toxic").repartition(tasks), "labelled")

    def gram_counts(batches):
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                found[label].update(set().union(*map(_grams, _text_units(text))))
        grams = list(found[0].keys() | found[1].keys())
        for i in range(0, len(grams), 50_000):
            part = grams[i : i + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": part,
                    "clean": pa.array([found[0][g] for g in part], pa.int64()),
                    "toxic": pa.array([found[1][g] for g in part], pa.int64()),
                }
            )

    totals = chosen.groupBy("toxic").count().collect()  # two rows
    number = {row["toxic"]: row["count"] for row in totals}
    if not number.get(0) or not number.get(1):
        return Model(None, None, 0.0)
    counts = chosen.mapInArrow(gram_counts, "gram string, clean long, toxic long")

    def surprise(hits, of: int):
        """The likelihood ratio's part for one class, against the share of both classes."""
        share = (F.col("clean") + F.col("toxic")) / float(number[0] + number[1])
        rate, miss = hits / float(of), 1 - hits / float(of)
        return 2 * (
            F.when(hits > 0, hits * F.log(rate / share)).otherwise(0.0)
            + F.when(hits < of, (of - hits) * F.log(miss / (1 - share))).otherwise(0.0)
        )

    odds = (
        counts.groupBy("gram")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") / number[1] > LIFT * F.col("clean") / number[0])
        .withColumn(
            "weight", surprise(F.col("toxic"), number[1]) + surprise(F.col("clean"), number[0])
        )
        .where(F.col("weight") > EVIDENCE)
        .orderBy(F.desc("weight"), "gram")
        .limit(KEPT_GRAMS)
        .collect()
    )
    weight = {row["gram"]: row["weight"] for row in odds}

    def witnesses(batches):
        for batch in batches:
            rows = []
            for text, label in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                units = sorted(_text_units(text))
                value = {u: max((weight.get(g, 0.0) for g in _grams(u)), default=0.0) for u in units}
                best = sorted(units, key=lambda u: (-value[u], u))[:WITNESSES]
                if label == 1:
                    best = [u for u in best if value[u] >= value[best[0]] / 2]
                else:
                    best += units[:: max(1, len(units) // WITNESSES)][:WITNESSES]
                rows.append({"toxic": label, "units": best})
            yield pa.RecordBatch.from_pylist(rows, schema=_BAGS)

    bags = chosen.mapInArrow(witnesses, "toxic int, units array<string>").collect()  # `sample` rows
    # A toxic text without evidence would teach noise.
    bad = [row["units"] for row in bags if row["toxic"] and row["units"]]
    bad = [units for units in bad if any(g in weight for g in _grams(units[0]))] or bad
    good = sorted({unit for row in bags if not row["toxic"] for unit in row["units"]})
    if not bad or not good:
        return Model(None, None, 0.0)
    model = _fit(Kernel(_landmarks(weight, bad, good)), bad, good)
    mined = chosen.mapInArrow(_suspects(model), "toxic int, units array<string>").collect()  # `sample` rows
    model = _refit(model, [(row["toxic"], row["units"]) for row in mined if row["units"]], bad, good)
    seen = chosen.mapInArrow(_worst_of(model), "worst double, toxic int").collect()  # `sample` rows
    _calibrate(model, np.array([r["worst"] for r in seen]), np.array([r["toxic"] for r in seen]))
    return model


def _suspects(model: Model):
    """The units that the model finds worst in each text."""

    def find(batches):
        for batch in batches:
            rows = []
            for text, label in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                units = sorted(_text_units(text))
                value = dict(zip(units, model.of_units(units).tolist()))
                best = sorted(units, key=lambda u: (-value[u], u))[:WITNESSES]
                rows.append({"toxic": label, "units": best})
            yield pa.RecordBatch.from_pylist(rows, schema=_BAGS)

    return find


def _worst_of(model: Model):
    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"worst": pa.array(model.worst(batch.column(0))), "toxic": batch.column(1)}
            )

    return score


def _landmarks(weight: dict[str, float], bad: list[list[str]], good: list[str]) -> list[str]:
    """Strings that stand for the others: the suspicious units' common stems, then some clean units."""
    stems: Counter = Counter()
    for units in bad:
        for unit in units:
            held = [g for g in _grams(unit) if g in weight]
            if held:
                # The stretch of the unit that its suspicious grams cover.
                begins = [unit.find(g) for g in held]
                ends = [begin + len(g) for begin, g in zip(begins, held)]
                stems[unit[min(begins) : max(ends)][:LANDMARK_CHARS]] += 1
            else:
                stems[unit[:LANDMARK_CHARS]] += 1
    ranked = [stem for stem, _ in sorted(stems.items(), key=lambda x: (-x[1], x[0])) if len(stem) >= LENGTH]
    marks = _spread_out(ranked[:400], LANDMARKS * 3 // 4)
    clean = [unit[:LANDMARK_CHARS] for unit in good if len(unit) >= LENGTH]
    clean = list(dict.fromkeys(clean[:: max(1, len(clean) // 200)]))
    return marks + [x for x in _spread_out(clean, LANDMARKS // 4) if x not in marks] or ["none"]


def _spread_out(strings: list[str], number: int) -> list[str]:
    """Strings in order, each the one that those before it stand for least (a pivoted Cholesky)."""
    if not strings:
        return []
    own = Kernel._self(strings)
    like = (subsequences(strings, strings) / np.sqrt(np.outer(own, own))) ** POWER
    left, factors, chosen = np.ones(len(strings)), np.zeros((len(strings), 0)), []
    rank = np.linspace(1, 0.5, len(strings))
    while len(chosen) < min(number, len(strings)):
        i = int(np.argmax(left * rank))
        if left[i] < NOVEL:
            break
        column = (like[:, i] - factors @ factors[i]) / np.sqrt(left[i])
        factors = np.hstack([factors, column[:, None]])
        left = np.maximum(left - column**2, 0)
        left[i] = 0
        chosen.append(strings[i])
    return chosen


def _fit(kernel: Kernel, bad: list[list[str]], good: list[str]) -> Model:
    """Trains, takes each text's worst unit by the result, and trains again."""
    flat = sorted({unit for units in bad for unit in units})
    features = dict(zip(flat, kernel.features(flat)))
    clean = kernel.features(good + _with_marks(good[:: max(1, len(good) // 500)]))
    picked = [unit for units in bad for unit in units]
    for _ in range(3):
        hidden = _with_marks(sorted(set(picked))[:400])
        positive = np.vstack([[features[u] for u in picked], kernel.features(hidden)])
        x = np.vstack([positive, clean])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(clean))])
        weights, offset = _machine(x, y)
        value = {u: float(features[u] @ weights) + offset for u in flat}
        picked = []
        for units in bad:
            picked += [u for u in units if value[u] > 0] or [max(units, key=value.__getitem__)]
    return Model(kernel, weights, offset)


def _refit(
    model: Model, bags: list[tuple[int, list[str]]], bad: list[list[str]], good: list[str]
) -> Model:
    """Trains on each text's worst unit, toxic and clean alike, found anew in every round, and on units that
    several toxic texts have evidence in."""
    often = sorted(u for u, n in Counter(u for units in bad for u in units).items() if n > 2)
    kernel, weights, offset = model.kernel, model.weights, model.offset
    flat = sorted({unit for _, units in bags for unit in units})
    place = {unit: i for i, unit in enumerate(flat)}
    features = kernel.features(flat)
    spare = good[:: max(1, len(good) // 500)]
    clean = kernel.features(spare + _with_marks(spare))
    sign = np.array([1 if label else -1 for label, _ in bags])
    for _ in range(ROUNDS):
        value = features @ weights + offset
        worst = [max(units, key=lambda u: value[place[u]]) for _, units in bags]
        sure = {u for u, s in zip(worst, sign) if s > 0 and value[place[u]] > 0}
        sure = sorted(sure)[:: max(1, len(sure) // 200)]
        hidden = kernel.features(often + _with_marks(often + sure) or worst[:1])
        x = np.vstack([features[[place[u] for u in worst]], hidden, clean])
        y = np.concatenate([sign, np.ones(len(hidden)), -np.ones(len(clean))])
        weights, offset = _machine(x, y)
    return Model(kernel, weights, offset)


def _calibrate(model: Model, worst: np.ndarray, label: np.ndarray) -> None:
    """Logistic slope and level by Newton steps that never lose, with targets that keep away from 0 and 1."""
    high, low = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (high + 1) / (high + 2), 1 / (low + 2))
    x = np.stack([worst, np.ones(len(worst))], axis=1)

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * beta @ beta)

    beta = np.array([0.0, np.log((high + 1) / (low + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (target - p) - 1e-3 * beta
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), slope)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.level = float(max(beta[0], 1e-3)), float(beta[1])


def score(frame: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """The columns of each row with its score, 0 to 1. A null or empty text scores as one without units."""
    kept = frame.select(*columns, F.coalesce(frame[text], F.lit("")).alias("_text"))

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                value = model.probability(model.worst(part.column(part.num_columns - 1)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(value)], names=[*columns, "score"]
                )

    schema = kept.drop("_text").schema.add("score", "double")
    return kept.mapInArrow(run, schema)


def held_out(key, parts: int, part: int):
    """Whether crc32 of the key as text leaves the remainder; a null key isn't held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, columns: list[str], sample: int = SAMPLE) -> DataFrame:
    """Trains on the labelled rows that aren't held out and scores every row of ``docs``.

    Repeated rows score alike; an empty table gives no rows. Other columns than the text are no inputs.
    """
    return score(docs, train(docs, labels, sample), columns)
