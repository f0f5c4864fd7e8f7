"""Language identification: the family first, then one-versus-one linear support vector machines within it."""

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.units import SMALL, Slice, slices

#: Families of languages by code: fixed values. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "turkic": "tr az kk ky uz tk",
    "uralic": "fi et hu",
    "indic": "hi bn mr ne gu pa ur",
    "semitic": "ar he am mt",
    "celtic": "ga cy br gd",
    "baltic": "lt lv",
    "sinitic": "zh yue wuu",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
#: The most labelled rows that a model is fitted on, all languages together, and the places of the hashed features.
SAMPLE, BITS = 3200, 12
UNKNOWN = "und"
#: Bounds of the standard deviations below a language's mean from which on a text is not taken for one in it.
MOST_DISTANT, LEAST_DISTANT = -10.0, -7.0
#: Variance between texts that is allowed for in any case: parts of a sound text may be code, names or numbers.
MIXED = 0.02

# Bytes as symbols: letters without regard to ASCII case, anything beyond ASCII as it is, all else one separator.
SYMBOL = np.zeros(256, np.uint32)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = np.arange(27, 155)
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def _places(part: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every pair and triple of symbols within a row, those of separators alone left out."""
    symbols = SYMBOL[part.data]
    rows = np.repeat(np.arange(len(part.bounds) - 1, dtype=np.int32), np.diff(part.bounds))
    out = []
    for n in (2, 3):
        if len(symbols) < n:
            continue
        first, last = symbols[: len(symbols) - n + 1], symbols[n - 1 :]
        code = first * _A + last * _B + (symbols[1:-1] * _C + np.uint32(977) if n == 3 else np.uint32(0))
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x27D4EB2F)
        same = rows[: len(first)] == rows[n - 1 :]
        fine = np.flatnonzero(same & ((first != 0) | (last != 0)))
        out.append((rows[fine], (code[fine] >> np.uint32(32 - BITS)).astype(np.int32)))
    return out


def _has_letter(part: Slice) -> np.ndarray:
    letters = (SYMBOL[part.data] > 0) & (SYMBOL[part.data] < 27)
    sums = np.concatenate([[0], np.cumsum(letters)])
    found = sums[part.bounds[1:]] > sums[part.bounds[:-1]]
    for row in np.flatnonzero(~found):
        found[row] = any(c.isalpha() for c in part.row(row).decode("utf-8", "replace"))
    return found


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature frequencies of each labelled text that are not zero: their places as uint16 and values as float32."""
    for batch in batches:
        places, values, sizes = [], [], []
        for part in slices(batch.column(1), SMALL):
            codes = [rows.astype(np.int64) << BITS | at for rows, at in _places(part)]
            codes, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_counts=True)
            rows, size = codes >> BITS, part.last - part.first
            total = np.bincount(rows, weights=counts, minlength=size)
            shares, at = (counts / total[rows]).astype(np.float32), (codes & ((1 << BITS) - 1)).astype(np.uint16)
            ends = np.searchsorted(rows, np.arange(1, size))
            places += [found.tobytes() for found in np.split(at, ends)]
            values += [found.tobytes() for found in np.split(shares, ends)]
            sizes += total.tolist()
        packed = [pa.array(places, pa.binary()), pa.array(values, pa.binary()), pa.array(sizes, pa.float64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *packed], names=["lang", "places", "x", "n"])


def _machine(
    x: np.ndarray, at: np.ndarray, y: np.ndarray, scale: float, cost: float = 10.0, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge) between the rows ``at`` of ``x``, whose sides
    are ``y``, by dual coordinate descent over the scaled rows; ``x`` is not copied, and the weights are for it as it is."""
    weights, bias, alpha = np.zeros(x.shape[1]), 0.0, np.zeros(len(at))
    share = {side: len(y) / (2 * max((y == side).sum(), 1)) for side in (-1, 1)}  # both sides count alike
    soft = np.array([0.5 / (cost * share[side]) for side in y])
    norms = np.array([x[i] @ x[i] for i in at]) * scale**2 + 1 + soft
    random = np.random.default_rng(7)
    for _ in range(rounds):
        for i in random.permutation(len(at)):
            row = x[at[i]]
            margin = scale * (weights @ row) + bias
            step = max(alpha[i] - (y[i] * margin - 1 + soft[i] * alpha[i]) / norms[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                weights += step * y[i] * scale * row
                bias += step * y[i]
    return weights * scale, bias


@dataclass
class Usual:
    """How the features of a language's texts are distributed: the logarithm of each one's share, the mean of that over a
    text, its variance (between texts, and by the number of features), and the least distance of a text that is taken."""

    logs: np.ndarray
    mean: float
    between: float
    each: float
    least: float = -np.inf

    @classmethod
    def of(cls, x: np.ndarray, n: np.ndarray) -> "Usual":
        """From the features of texts: three in four for the shares, the fourth to set what is taken, namely all but one
        in five hundred, and what is up to half as far again, within the bounds given as constants."""
        test = np.arange(len(x)) % 4 == 3
        learn = x if len(x) < 8 else x[~test]
        share = (learn.sum(0, dtype=np.float64) + 0.01) / (len(learn) + 0.01 * x.shape[1])
        logs = np.log(share)
        means = learn @ logs
        long = means[n[~test if len(x) >= 8 else slice(None)] >= np.median(n)]
        mean = float(np.median(long if len(long) else means))
        found = cls(logs, mean, float(np.median((long - mean) ** 2)) * 2.2 + MIXED, float(share @ logs**2 - (share @ logs) ** 2) * 4)
        if test.any():
            least = float(np.quantile(found.distance(x[test] @ logs, n[test]), 0.002)) * 1.5
            found.least = min(max(least, MOST_DISTANT), LEAST_DISTANT)
        return found

    def distance(self, means: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Standard deviations that texts of n features lie above the mean."""
        return (means - self.mean) / np.sqrt(self.between + self.each / np.maximum(n, 1))


@dataclass
class Model:
    """Machines between families and, within each, between two of its languages; ``duels`` names the sides."""

    families: dict[str, list[str]] = field(default_factory=dict)
    duels: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 1 << BITS)))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0))
    usual: dict[str, "Usual"] = field(default_factory=dict)

    def choose(self, sides: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner (place in ``sides``) of the duels among ``sides`` for each row, and how sure the closest of its duels
        is; most duels won, then the larger sum of margins, then the first."""
        rows = margins.shape[0]
        wins, sums = np.zeros((rows, len(sides))), np.zeros((rows, len(sides)))
        least = np.full((rows, len(sides)), np.inf)
        for a, b in combinations(range(len(sides)), 2):
            margin = margins[:, self.duels.index((sides[a], sides[b]))]
            for side, value in ((a, margin), (b, -margin)):
                wins[:, side] += value >= 0 if side == a else value > 0
                sums[:, side] += value
                least[:, side] = np.minimum(least[:, side], value)
        best = np.lexsort((-np.arange(len(sides))[None, :].repeat(rows, 0), sums, wins), axis=1)[:, -1] if rows else np.zeros(0, int)
        closest = least[np.arange(rows), best]
        return best, 1 / (1 + np.exp(-np.clip(4 * closest, -30, 30)))

    def familiar(self, part: Slice) -> np.ndarray:
        """Which rows have features as usual in some language."""
        rows, found = len(part.bounds) - 1, _places(part)
        out, counts = np.zeros(rows, bool), sum((np.bincount(at, minlength=rows) for at, _ in found), np.zeros(rows))
        for usual in self.usual.values():
            sums = sum((np.bincount(at, weights=usual.logs[places], minlength=rows) for at, places in found), np.zeros(rows))
            out |= usual.distance(sums / np.maximum(counts, 1), counts) >= usual.least
        return out

    def predict(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        rows = len(part.bounds) - 1
        margins, counts = np.zeros((rows, len(self.duels))), np.zeros(rows)
        for at, places in _places(part):
            counts += np.bincount(at, minlength=rows)
            for i, weights in enumerate(self.weights):
                margins[:, i] += np.bincount(at, weights=weights[places], minlength=rows)
        margins = margins / np.maximum(counts, 1)[:, None] + self.biases
        names = list(self.families)
        langs, scores = np.full(rows, UNKNOWN, object), np.zeros(rows)
        if names:
            family, sure = self.choose(names, margins)
            for i, name in enumerate(names):
                at, inside = np.flatnonzero(family == i), self.families[name]
                best, closest = self.choose(inside, margins[at])
                langs[at] = np.array(inside, object)[best]
                scores[at] = sure[at] * closest
            blank = ~_has_letter(part)
            langs[blank], scores[blank] = UNKNOWN, 0.0
        return langs, scores


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from rows whose ``lang`` is not null: at most ``sample`` rows, spread evenly over the languages and
    chosen by a hash of ``key``. Features come from whole texts. Rows with a null text are left out; without rows the
    model knows no language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {row[0]: row[1] for row in rows.groupBy(lang).count().orderBy(lang).limit(sample).collect()}
    codes = sorted(counts)
    each = max(sample // max(len(codes), 1), 1)
    order = F.xxhash64(F.col(key).cast("string"), F.lit("lang"))
    rank = F.row_number().over(Window.partitionBy(lang).orderBy(order, key))
    # of a language with many rows only those with low hashes, about four times as many as wanted, are ranked
    low = F.lit(False)
    for code in codes:
        low |= (F.col(lang) == code) & (order / F.lit(2.0**64) + 0.5 <= min(4 * (each + 25) / counts[code], 1.0))
    # ranked by the key alone; the texts of the chosen rows, at most `sample`, are read afterwards
    keys = rows.where(low).select(key, lang).distinct().withColumn("_rank", rank).where(F.col("_rank") <= each).select(key, lang)
    chosen = rows.select(key, lang, text).join(F.broadcast(keys), [key, lang], "left_semi")
    # of rows that repeat a key and a language the first by text
    chosen = chosen.groupBy(key, lang).agg(F.min(text).alias("text")).select(F.col(lang).alias("lang"), "text")
    found = chosen.mapInArrow(_frequencies, "lang string, places binary, x binary, n double").toArrow()
    found = sorted(zip(*(column.to_pylist() for column in found.columns)))
    x, y = np.zeros((len(found), 1 << BITS), np.float32), np.array([row[0] for row in found], object)
    sizes = np.array([row[3] for row in found], np.float64)
    for row, (_, places, values, _) in zip(x, found):
        row[np.frombuffer(places, np.uint16)] = np.frombuffer(values, np.float32)
    del found
    scale = 1 / max(float(np.mean([np.sqrt(row @ row) for row in x])), 1e-9) if len(x) else 1.0
    model = Model()
    for code in codes:
        model.families.setdefault(FAMILY.get(code, code), []).append(code)
    of = np.array([FAMILY.get(code, code) for code in y], object)
    made = []
    for sides, names in [(sorted(model.families), of), *((codes, y) for codes in model.families.values())]:
        for a, b in combinations(sides, 2):
            at = np.flatnonzero((names == a) | (names == b))
            model.duels.append((a, b))
            made.append(_machine(x, at, np.where(names[at] == a, 1, -1), scale))
    model.families = {name: model.families[name] for name in sorted(model.families)}
    model.usual = {code: Usual.of(x[y == code], sizes[y == code]) for code in codes if (y == code).any()}
    if made:
        model.weights, model.biases = np.array([m[0] for m in made]), np.array([m[1] for m in made])
    return model


def identify(
    docs: DataFrame, model: Model, text: str = "text", columns: tuple[str, str] = ("lang_pred", "score"), known: str | None = None
) -> DataFrame:
    """``docs`` with the predicted language of each whole text and a score from 0 to 1 (columns of these names are
    replaced). A null text, an empty one, one without letters, or a model that knows no language give `und` and 0. One
    pass without a shuffle, the model's few machines travel with it; repeated rows are predicted alike. A column named by
    ``known`` tells whether the text's features are as usual in one of the languages: of the texts that the model
    was tried on but did not learn from, nearly all are (see :class:`Usual`); one in a language that it does not know, or
    of random letters, is not, unless it is so short that it might be."""
    kept = [c for c in docs.columns if c not in (*columns, known)]
    docs = docs.select(*kept)
    more = f"`{columns[0]}` string, `{columns[1]}` double" + (f", `{known}` boolean" if known else "")
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(more).fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, usual = [], [], []
            for part in slices(batch.column(kept.index(text)), SMALL):
                some, sure = model.predict(part)
                langs += some.tolist()
                scores += np.round(sure, 6).tolist()
                usual += model.familiar(part).tolist() if known else []
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())] + [pa.array(usual, pa.bool_())] * bool(known)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, *columns, *[known] * bool(known)])

    return docs.mapInArrow(add, schema)


def held_out(key: str = "doc_id"):
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
