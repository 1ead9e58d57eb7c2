"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed to 2^BITS features. Document frequencies are counted over all learning
rows; weights are trained by follow-the-regularised-leader with elastic-net penalties on a bounded sample, and a
temperature fitted on rows that training didn't see calibrates the probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS

BITS = 14
DIM = 1 << BITS
UNKNOWN = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str) -> np.ndarray:
    """Feature numbers of a text's n-grams: runs of characters that are not letters count as one space. Empty without letters."""
    t = re.sub(r"[\W\d_]+", " ", text).lower()
    if not t.strip():
        return np.empty(0, dtype=np.int64)
    c = np.frombuffer(f" {t.strip()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    one = c * _ODD
    two = (c[:-1] << np.uint64(21) | c[1:]) * _ODD + np.uint64(1)
    three = (((c[:-2] << np.uint64(21) | c[1:-1]) << np.uint64(21)) | c[2:]) * _ODD + np.uint64(2)
    return (np.concatenate([one, two, three]) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(indices, values) of the text's TF-IDF vector of length 1, term frequency as 1 + log; None without a letter."""
    g = grams(text) if text else ()
    if not len(g) or not any(map(str.isalpha, text)):
        return None
    counts = np.bincount(g, minlength=DIM)
    at = np.nonzero(counts)[0]
    v = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((v * v).sum())
    return at, (v / norm if norm else v)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many of docs have each feature, and how many have any: tasks send packed counts, summed by block of features."""
    blocks = 16

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(DIM + blocks, dtype=np.int64)
        for b in batches:
            for t in b["t"]:
                if t and len(g := grams(t)):
                    df[:DIM][np.bincount(g, minlength=DIM) > 0] += 1
                    df[DIM] += 1
        wide = DIM // blocks
        yield pd.DataFrame([(k, df[k * wide : (k + 1) * wide].tobytes(), int(df[DIM]) if not k else 0) for k in range(blocks)], columns=["k", "v", "n"])

    def add(b: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, dtype=np.int64) for v in b["v"]], axis=0)
        return pd.DataFrame([(b["k"].iloc[0], total.tobytes(), int(b["n"].sum()))], columns=["k", "v", "n"])

    parts = docs.select(F.col(text).alias("t")).mapInPandas(count, "k int, v binary, n long")
    rows = parts.groupBy("k").applyInPandas(add, "k int, v binary, n long").collect()  # `blocks` rows of fixed length
    out = np.zeros(DIM, dtype=np.int64)
    for r in rows:
        out[r["k"] * (DIM // blocks) : (r["k"] + 1) * (DIM // blocks)] = np.frombuffer(r["v"], dtype=np.int64)
    return out, sum(r["n"] for r in rows)


class Ftrl:
    """FTRL-proximal for multinomial logistic regression with L1 and L2 penalties."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((classes, DIM + 1)), np.zeros((classes, DIM + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, v: np.ndarray, y: int) -> None:
        at, v = np.append(at, DIM), np.append(v, 1.0)
        w = self.weights(at)
        p = _softmax(w @ v)
        p[y] -= 1
        g = p[:, None] * v
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits with the least negative log likelihood, by golden section over its logarithm."""

    def loss(t: float) -> float:
        x = logits / np.exp(t)
        m = x.max(1)
        return float((m + np.log(np.exp(x - m[:, None]).sum(1)) - x[np.arange(len(y)), y]).mean())

    a, b, r = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", max_rows: int = 4000, least_rows: int = 40, epochs: int = 3) -> dict:
    """Model from docs' text and non-null lang. All rows count for document frequencies; weights see about max_rows rows, shared out evenly over all languages, or least_rows of each where that is more, chosen by the key's hash. Every fifth of them calibrates, but for a language's only ones."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"))
    df, n = document_frequencies(rows, "t")
    idf = np.log((1 + n) / (1 + df)) + 1
    langs = rows.groupBy("lang").count().collect()  # one row for each language
    if not langs:
        return {"langs": [], "idf": idf}
    share = max(max_rows / len(langs), least_rows)
    unit = F.pmod(F.xxhash64(F.coalesce("k", F.lit(""))), F.lit(1 << 20)) / float(1 << 20)
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, share / r["count"])) for r in langs], "lang string, rate double")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [(lang, f[0].astype("<i4").tobytes(), f[1].astype("<f4").tobytes(), k) for t, lang, k in zip(b["t"], b["lang"], b["k"], strict=True) if (f := features(t, idf))]
            yield pd.DataFrame(made, columns=["lang", "at", "v", "k"])

    sample = rows.join(F.broadcast(rates) if len(langs) <= BROADCAST_ROWS else rates, "lang").where(unit < F.col("rate")).mapInPandas(vectors, "lang string, at binary, v binary, k string").collect()  # the rates bound it
    sample.sort(key=lambda r: (str(r["k"])[::-1], bytes(r["at"]), r["lang"]))
    names = sorted({r["lang"] for r in sample})
    data = [(np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["v"], "<f4").astype(float), names.index(r["lang"])) for r in sample]
    taught = {y for i, (*_, y) in enumerate(data) if i % 5}
    held, used = [x for x in data[::5] if x[2] in taught], [x for i, x in enumerate(data) if i % 5 or x[2] not in taught]
    model, order = Ftrl(len(names)), np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(used)):
            model.learn(*used[i])
    w = model.weights()
    logits = np.array([w[:, at] @ v + w[:, DIM] for at, v, _ in held]) if held else np.zeros((0, len(names)))
    t = temperature(logits, np.array([y for *_, y in held])) if len(names) > 1 and len(held) >= 20 else 1.0
    return {"langs": names, "idf": idf, "weights": w, "temperature": t}


def predict(docs: DataFrame, model: dict, *, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the calibrated probability; UNKNOWN and 0 for texts that are null or have no letter, and for all without learned languages. Repeated rows each get theirs; columns lang_pred and score of docs are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast({**model, "weights": np.ascontiguousarray(model["weights"].T)} if model["langs"] else model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def classify(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        out = []
        for t in texts:
            f = features(t, m["idf"]) if m["langs"] else None
            if f is None:
                out.append((UNKNOWN, 0.0))
                continue
            p = _softmax((f[1] @ m["weights"][f[0]] + m["weights"][DIM]) / m["temperature"])
            k = int(p.argmax())
            out.append((m["langs"][k], float(p[k])))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")], F.inline(F.array(classify(F.col(text)))))
