"""Toxicity by a weighted finite-state pattern grammar.

Transducers over the symbols of a clause are composed into one: a lexicon reads words, several at once for entries of
more, as insult, threat, target, negation or report, with the entry's weight; the negation and the report transducer
mark insults and threats within their reach; the target transducer marks those near a target, before or after it.
What comes out are clause patterns ("insult at a target", "negated insult", "reported threat", ...). Documents are
scored by their matched clauses: how many match each pattern, and the weight of the heaviest path. The patterns'
weights, and words that join the insults, are learned from labelled rows.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The transducers' own words.
INSULTS = "idiot idiots moron morons clown scum trash worthless pathetic disgusting stupid loser losers dumb fool fools imbecile jerk vermin filth filthy garbage ugly creep coward pig swine bastard idiota estúpido imbécil basura asqueroso idiote crétin imbécile ordure minable dégoûtant dummkopf abschaum müll erbärmlich widerlich".split()
THREATS = "kill hurt destroy beat attack shoot stab burn crush punch smash hunt strangle matar golpear destruir tuer frapper détruire töten schlagen vernichten".split()
TARGETS = "you your u ye he she they them him her his their these those people everyone this that tú usted ellos ellas tu toi vous ils elles du dich ihr euch sie".split()
NEGATIONS = "not no never none isn't aren't wasn't don't doesn't didn't without hardly nunca jamás ne pas jamais nicht kein keine nie".split()
REPORTS = "said says say wrote writes quoted quotes claimed claims called calls reported reports according dijo dice écrit sagte schrieb laut".split()
#: Entries of more than one word.
INSULT_PHRASES = ("piece of trash", "piece of garbage", "waste of space", "good for nothing")
THREAT_PHRASES = ("drop dead", "go to hell", "beat up", "get rid of", "hunt down")
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

#: What a clause's words compose to: an insult (I) or threat (H), at a target (@), negated (-) or reported (~).
PATTERNS = {"I": "insult", "I@": "insult_target", "I-": "insult_negated", "I~": "insult_reported", "H": "threat", "H@": "threat_target", "H-": "threat_negated", "H~": "threat_reported"}
#: The features of a document: clauses that match each pattern, whether any matches, their share, the heaviest path, and the most matches in one.
FEATURES = (*(f"log_{p}" for p in PATTERNS.values()), "any", "share", "heaviest", "most_in_clause")
WORD_SYMBOL, END = "w", "$"
REACH = 4


class Transducer:
    """Finite-state transducer: arcs(state, symbol) gives the next state and the symbols put out. An arc is worked out when it is first taken and kept."""

    def __init__(self, start, arcs: Callable):
        self.start, self.arcs, self.table = start, arcs, {}

    def step(self, state, symbol: str) -> tuple:
        arc = self.table.get((state, symbol))
        if arc is None:
            arc = self.table[state, symbol] = self.arcs(state, symbol)
        return arc

    def read(self, symbols: list[str]) -> list[str]:
        """All that is put out for symbols and the clause's end."""
        state, out = self.start, []
        for s in (*symbols, END):
            state, more = self.step(state, s)
            out += more
        return out


def composed(*parts: Transducer) -> Transducer:
    """The parts one after the other as a single transducer, whose states are tuples of theirs."""

    def arcs(states: tuple, symbol: str) -> tuple:
        new, line = [], [symbol]
        for part, state in zip(parts, states, strict=True):
            out = []
            for s in line:
                state, more = part.step(state, s)
                out += more
            new.append(state)
            line = out
        return tuple(new), tuple(line)

    return Transducer(tuple(p.start for p in parts), arcs)


def _negation(left: int, s: str) -> tuple:
    """State: words for which a negation still reaches."""
    return (REACH + 1 if s == "N" else max(0, left - 1)), (s + "-" if left > 0 and s in ("I", "H") else s,)


def _report(seen: bool, s: str) -> tuple:
    return seen or s == "R", (s + "~" if seen and s in ("I", "H") else s,)


def _target(state: tuple, s: str) -> tuple:
    """State: words for which the last target still reaches, and what waits for a target after it: (symbol, words left)."""
    near, waiting = state
    if s == END:
        return (0, ()), (*(k for k, _ in waiting), END)
    if s == "T":
        return (REACH + 1, ()), (*(k + "@" for k, _ in waiting), s)
    gone = tuple(k for k, left in waiting if left == 1)
    waiting = tuple((k, left - 1) for k, left in waiting if left > 1)
    if s in ("I", "H"):
        return (max(0, near - 1), waiting if near else (*waiting, (s, REACH))), (*gone, *([s + "@"] if near else []))
    return (max(0, near - 1), waiting), (*gone, s)


class Grammar:
    """insults: entry -> weight, entries of several words included. A clause is read once, left to right."""

    def __init__(self, insults: dict[str, float]):
        self.lexicon: dict = {}
        for symbol, entries in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", (*THREATS, *THREAT_PHRASES)), ("I", insults)):
            for e in entries:
                at = self.lexicon
                for w in e.split():
                    at = at.setdefault(w, {})
                at[None] = (symbol, insults.get(e, 1.0) if symbol == "I" else 1.0 if symbol == "H" else 0.0)
        self.patterns = composed(Transducer(0, _negation), Transducer(False, _report), Transducer((0, ()), _target))
        self.trigger = ahocorasick.Automaton()
        for w in {e.split()[0] for e in (*insults, *THREATS, *THREAT_PHRASES)}:
            self.trigger.add_word(w, len(w))
        self.trigger.make_automaton()

    def triggered(self, low: str) -> list[int]:
        """Where the whole words that can begin a pattern start."""
        out, n = [], len(low)
        for end, k in self.trigger.iter(low):
            s = end - k + 1
            if (not s or not low[s - 1].isalpha()) and (end + 1 == n or not low[end + 1].isalpha()):
                out.append(s)
        return out

    def symbols(self, words: list[str]) -> tuple[list[str], float]:
        """The lexicon's reading of words, longest entries first, and its weight."""
        out, weight, i = [], 0.0, 0
        while i < len(words):
            at, k, best = self.lexicon, i, None
            while k < len(words) and words[k] in at:
                at, k = at[words[k]], k + 1
                if None in at:
                    best = at[None], k
            (symbol, more), i = best or ((WORD_SYMBOL, 0.0), i + 1)
            out.append(symbol)
            weight += more
        return out, weight

    def clause(self, words: list[str]) -> tuple[Counter, float]:
        """How often each pattern matches, and the path's weight: 0 where all is negated or reported."""
        symbols, weight = self.symbols(words)
        found = Counter(x for x in self.patterns.read(symbols) if x in PATTERNS)
        return found, weight if any(k[-1] not in "-~" for k in found) else 0.0

    def features(self, text: str | None) -> np.ndarray:
        """FEATURES of a text; clauses without a word that can begin a pattern are only counted."""
        clauses, matched, most, heaviest, n = Counter(), 0, 0, 0.0, 0
        low = (text or "").lower()
        if starts := self.triggered(low):
            bounds = [0, *(x for m in CLAUSE.finditer(low) for x in m.span()), len(low)]
            n = len(bounds) // 2
            for k in sorted({bisect.bisect_right(bounds, x) - 1 for x in starts}):
                found, weight = self.clause(WORD.findall(low[bounds[k] : bounds[k + 1]]))
                if found:
                    matched, most, heaviest = matched + 1, max(most, found.total()), max(heaviest, weight)
                    clauses.update(found.keys())
        return np.array([*(math.log1p(clauses[p]) for p in PATTERNS), float(matched > 0), 10 * matched / (n + 5), heaviest, math.log1p(most)])


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 20_000) -> dict:
    """Grammar and weights from at most about max_rows labelled rows, chosen by the hash of doc_id.

    All words that are far commoner in toxic rows join the insults, weighted by their log odds; words of the fixed list
    that labelled rows contradict leave it. The patterns' weights are learned with both labels balanced (see balanced). Repeated labels of a document count by their largest; null labels and ids,
    and labels of no document, are left out. Without labels of both kinds no weights are learned.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("_y"))
    n = one.count()
    rate = min(1.0, max_rows / max(n, 1))
    few = one.where(F.pmod(F.xxhash64(doc_id, F.lit(5)), F.lit(1 << 20)) < rate * (1 << 20)).withColumnRenamed(doc_id, "_id")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("t")).join(F.broadcast(few), "_id")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for b in batches:
            for t, y in zip(b["t"], b["_y"], strict=True):
                seen.update((w, int(y)) for w in set(WORD.findall((t or "").lower())))
                seen[("", int(y))] += 1
        yield pd.DataFrame([(w, y, c) for (w, y), c in seen.items()], columns=["w", "y", "c"])

    per = rows.mapInPandas(words, "w string, y int, c long").groupBy("w").agg(F.sum(F.when(F.col("y") == 1, F.col("c")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 1, 0).otherwise(F.col("c"))).alias("neg"))
    size = per.where("w = ''").first()
    pos, neg = (size["pos"], size["neg"]) if size else (0, 0)
    if not pos or not neg:
        return {"insults": dict.fromkeys((*INSULTS, *INSULT_PHRASES), 1.0), "weights": [0.0] * len(FEATURES), "bias": -1.0 if not pos else 1.0}
    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
    least = max(5, pos // 200)
    known = F.col("w").isin(*INSULTS)
    found = per.where("w <> ''").withColumn("odds", odds).where(((F.col("pos") >= least) & (F.col("odds") > 1.5)) | known).collect()  # no more than the words of max_rows texts
    insults = {w: 1.0 for w in (*INSULTS, *INSULT_PHRASES)} | {r["w"]: max(0.1, float(r["odds"])) for r in found if r["odds"] > 0.5 or r["pos"] + r["neg"] < 5}
    for r in found:
        if r["odds"] <= 0.5 and r["pos"] + r["neg"] >= 5:
            insults.pop(r["w"], None)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar, c = Grammar(insults), Counter()
        for b in batches:
            for t, y in zip(b["t"], b["_y"], strict=True):
                c[(grammar.features(t).round(3).tobytes(), int(y))] += 1
        yield pd.DataFrame([(v, y, k) for (v, y), k in c.items()], columns=["v", "y", "c"])

    sample = rows.mapInPandas(vectors, "v binary, y int, c long").groupBy("v", "y").agg(F.sum("c").alias("c")).orderBy("v", "y").collect()
    x = np.array([np.frombuffer(r["v"]) for r in sample])
    y, c = np.array([r["y"] == 1 for r in sample], float), np.array([r["c"] for r in sample], float)
    w = logistic(np.hstack([x, np.ones((len(x), 1))]), y, balanced(y, c))
    return {"insults": insults, "weights": list(w[:-1]), "bias": float(w[-1])}


def balanced(y: np.ndarray, c: np.ndarray, most: float = 10.0) -> np.ndarray:
    """Counts in which the rarer of both labels weighs as much as the other, but a row no more than `most` times: where few texts are toxic, a plain fit puts one half of the score beyond many of them."""
    ones, zeros = float((c * y).sum()), float((c * (1 - y)).sum())
    return c * np.where(y == 1, min(most, max(1.0, zeros / ones)), min(most, max(1.0, ones / zeros))) if ones and zeros else c


def logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression of rows counted c times, by Newton steps; the last column is not penalised."""
    w, pen = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pen[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (c * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(pen), x.T @ (c * (y - p)) - pen * w)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: dict, *, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (score >= 0.5); null and empty texts match nothing and get the bias alone. Repeated rows each get theirs; columns score and predicted of docs are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        m = shared.value
        grammar, w = Grammar(m["insults"]), np.array(m["weights"])
        z = [float(grammar.features(t) @ w) + m["bias"] for t in texts]
        return pd.Series([1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z])

    return docs.withColumn("score", rate(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
