"""Secret scans by grammar inference.

Labelled credentials (values that the fixed patterns find) of each kind are read into a prefix tree over character
classes, whose states are merged where their futures agree within Hoeffding's bound: the shares of each next class (the
ALERGIA test) and the distribution of what is left to read, so that a format of fixed length keeps its states however
few strings there are. The automaton gives every candidate string a likelihood; candidates that one kind's automaton
finds much likelier than that of ordinary tokens does are secrets by format, next to the fixed patterns' own matches,
which always stay.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: The patterns of the contract.
ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # the same as all AKIA[A-Z0-9]+ of 16 characters or more, as are those of HEX
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "format")
#: A candidate for its format: a whole run of these characters, with single dots inside, however long, of 16 or more, or of 8 or more with a letter and a digit.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?<![A-Za-z0-9+/_=-]\.)[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")
LONG_RUN, SHORT_RUN = 16, 8
#: Ordinary words teach the contrast too: one in WORDS of those with 8 letters or more, by hash.
WORD, WORDS = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{8,}(?![A-Za-z0-9+/_=-])"), 64
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
CUE = re.compile(r"(?ai:passw|secret|token|api)")

SEPARATORS = "+/_=-."
ALPHABET = {**{c: "d" for c in "0123456789"}, **{c: "h" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"}, **{c: "H" for c in "ABCDEF"}, **{c: "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}, **{c: c for c in SEPARATORS}}
CLASS_SIZE = {"d": 10, "h": 6, "l": 20, "H": 6, "L": 20, **dict.fromkeys(SEPARATORS, 1)}
END = "$"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the fixed patterns' matches, leftmost and non-overlapping for each kind; matches that are too short are dropped."""
    out = [(m.start(), m.end(), "assign", m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8] if CUE.search(text) else []
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return out


def candidates(text: str, base: list[tuple[int, int, str, str]]) -> Iterator[re.Match]:
    """The text's whole runs that overlap none of the base spans."""
    ends = sorted((s, e) for s, e, *_ in base)
    at, last = 0, 0
    for m in RUN.finditer(text):
        n = m.end() - m.start()
        if n < SHORT_RUN or n < LONG_RUN and not (DIGIT.search(m[0]) and LETTER.search(m[0])):
            continue
        while at < len(ends) and ends[at][0] < m.end():
            last, at = max(last, ends[at][1]), at + 1
        if last <= m.start():
            yield m


class Automaton:
    """Probabilistic deterministic automaton over character classes, inferred from strings."""

    def __init__(self, step: list[dict[str, int]], logp: list[dict[str, float]]):
        self.step, self.logp = step, logp

    @classmethod
    def infer(cls, strings: list[str], alpha: float = 0.05, lengths: bool = True) -> Automaton:
        """Prefix tree of the strings' classes, then its states merged in breadth-first order; without lengths, what is left to read doesn't keep states apart.

        What only one string reaches stays text until a step needs it, so long strings cost their characters, not states.
        """
        child, count, tail, rest = [], [], [], []  # rest: lengths of what is left to read

        def new(s: str, k: int) -> int:
            child.append({})
            count.append(Counter(s[k : k + 1]))
            rest.append(Counter([len(s) - k] if s else []))
            tail.append((s, k) if s else None)
            return len(child) - 1

        def unfold(p: int) -> None:
            if tail[p]:
                (s, k), tail[p] = tail[p], None
                if s[k] != END:
                    child[p][s[k]] = new(s, k + 1)

        def add(p: int, s: str, k: int) -> None:
            """Counts s from its k-th class on, below p."""
            while True:
                unfold(p)
                c = s[k]
                count[p][c] += 1
                rest[p][len(s) - k] += 1
                if c == END:
                    return
                k += 1
                if c not in child[p]:
                    child[p][c] = new(s, k)
                    return
                p = child[p][c]

        new("", 0)
        for s in strings:
            add(0, "".join(map(ALPHABET.__getitem__, s)) + END, 0)
        bound = math.sqrt(0.5 * math.log(2 / alpha))

        def apart(x: Counter, n: int, y: Counter, m: int) -> float:
            """The largest difference of two cumulative distributions."""
            most, f, g = 0.0, 0, 0
            for v in sorted(x.keys() | y.keys()):
                f, g = f + x[v], g + y[v]
                most = max(most, abs(f / n - g / m))
            return most

        def differs(a: int, b: int) -> bool:
            todo = [(a, b)]
            while todo:
                p, q = todo.pop()
                n, m = sum(count[p].values()), sum(count[q].values())
                if not n or not m or (min(n, m) == 1 and bound >= 1):  # no share of one string is beyond such a bound, nor is any below
                    continue
                gap = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                if any(abs(count[p][c] / n - count[q][c] / m) > gap for c in count[p].keys() | count[q].keys()) or lengths and apart(rest[p], n, rest[q], m) > gap:
                    return True
                unfold(p)
                unfold(q)
                todo += [(child[p][c], child[q][c]) for c in child[p].keys() & child[q].keys()]
            return False

        def fold(a: int, b: int) -> None:
            """Adds b's tree to a."""
            todo = [(a, b)]
            while todo:
                p, q = todo.pop()
                if tail[q]:
                    add(p, *tail[q])
                    continue
                unfold(p)
                count[p] += count[q]
                rest[p] += rest[q]
                for c, to in child[q].items():
                    if c in child[p]:
                        todo.append((child[p][c], to))
                    else:
                        child[p][c] = to

        red, blue = [0], [(0, c) for c in sorted(child[0])]
        while blue:
            parent, c = blue.pop(0)
            state = child[parent][c]
            if state in red:
                continue
            for r in red:
                if not differs(r, state):
                    child[parent][c] = r
                    fold(r, state)
                    blue = [(p, x) for p in red for x in sorted(child[p]) if child[p][x] not in red]
                    break
            else:
                unfold(state)
                red.append(state)
                blue += [(state, x) for x in sorted(child[state])]
        number = {s: i for i, s in enumerate(red)}
        logp = []
        for s in red:
            more = sum(count[s][c] + 0.1 for c in CLASS_SIZE)
            logp.append({c: math.log((count[s][c] + 0.1) / more / z) for c, z in CLASS_SIZE.items()} | {END: math.log((count[s][END] + 0.1) / (more + count[s][END] + 0.1))})
        return cls([{c: number[t] for c, t in child[s].items()} for s in red], logp)

    def score(self, s: str, ends: bool = True) -> float:
        """Log likelihood for each character, given that there is one: the length counts once, by the end, if it should. Characters that no transition knows are taken from the state itself."""
        at, total = 0, 0.0
        for c in s:
            k = ALPHABET.get(c, "_")
            total += self.logp[at][k]
            at = self.step[at].get(k, at)
        return (total + self.logp[at][END]) / (len(s) + 1) if ends else total / len(s)


def fit(docs: DataFrame, *, text: str = "text", max_labelled: int = 2000, longest: int = 1000, margin: float = 0.15) -> dict | None:
    """One automaton for each kind of credential and one of ordinary strings, from at most max_labelled distinct values of each (the smallest by hash over all documents); None without credentials.

    A value that was found as several kinds teaches each of them. Values of more than `longest` characters teach
    nothing, so what comes to the driver is bounded in bytes, however long a text or a run is; they are scored like all others.
    A kind of one value has no threshold of its own and finds nothing.

    Ordinary strings are the candidates of all texts that overlap no fixed pattern's match, and words, but for those that
    a first round finds likelier as credentials. A kind's
    threshold is the lowest likelihood ratio of the upper nineteen twentieths of its labelled values, each held out in
    turn with a third of them (one by one, if there are fewer than six), or margin if that is more: it doesn't depend on the size of docs.
    """

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for t in b["t"]:
                if t:
                    found = base_spans(t)
                    out |= {(v, k) for _, _, k, v in found}
                    out |= {(m[0], "") for m in candidates(t, found)}
                    out |= {(w, "") for w in set(WORD.findall(t)) if zlib.crc32(w.encode()) % WORDS == 0}
            yield pd.DataFrame(list(out), columns=["value", "kind"])

    found = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull()).mapInPandas(values, "value string, kind string")
    # what is labelled anywhere is no ordinary string elsewhere
    found = written(found.where(F.length("value") <= longest).groupBy("value").agg(*[F.max(F.col("kind") == k).alias(f"is_{k}") for k in KINDS[:3]]), "values")
    is_kind = {k: F.col(f"is_{k}") for k in KINDS[:3]} | {"": ~F.greatest(*[F.col(f"is_{k}") for k in KINDS[:3]])}
    take = lambda k: [r[0] for r in found.where(is_kind[k]).orderBy(F.xxhash64("value"), "value").limit(max_labelled).select("value").collect()]
    secrets = {k: v for k in KINDS[:3] if (v := take(k))}
    if not secrets:
        return None
    plain = take("") or ["the"]
    other = Automaton.infer(plain, lengths=False)
    kinds = {k: Automaton.infer(v) for k, v in secrets.items()}
    # credentials that no fixed pattern found are among the ordinary strings: those that a kind explains better don't teach the contrast
    other = Automaton.infer([s for s in plain if all(a.score(s) < other.score(s, False) for a in kinds.values())] or plain, lengths=False)
    model = {"other": (other.step, other.logp), "kinds": {}}
    for k, v in secrets.items():
        if len(v) < 2:
            continue
        n = 3 if len(v) >= 6 else len(v)
        folds = [(Automaton.infer([s for i, s in enumerate(v) if i % n != out]), v[out::n]) for out in range(n)]
        ratios = sorted(a.score(s) - other.score(s, False) for a, held in folds for s in held)
        model["kinds"][k] = (kinds[k].step, kinds[k].logp, max(margin, ratios[len(ratios) // 20]))
    return model


def scan(docs: DataFrame, model: dict | None, *, text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with column `out`: array of (kind, start, end) by start, then kind as listed in KINDS; code points, end exclusive.

    A kind "format" span is a whole candidate run (see RUN) that overlaps no other span and is likelier under the
    automaton of one kind of credential, by its threshold. Null and empty texts have no spans; repeated rows each get
    theirs. A column `out` of docs is replaced, others stay.
    """
    other = Automaton(*model["other"]) if model else None
    good = [(Automaton(step, logp), least) for step, logp, least in model["kinds"].values()] if model else []
    rank = {k: i for i, k in enumerate(KINDS)}

    def spans(t: str | None) -> list[dict]:
        if not t:
            return []
        base = base_spans(t)
        found = [x[:3] for x in base]
        if model:
            for m in candidates(t, base):
                plain = other.score(m[0], False)
                if any(a.score(m[0]) - plain >= least for a, least in good):
                    found.append((m.start(), m.end(), "format"))
        found.sort(key=lambda x: (x[0], rank[x[2]]))
        return [{"kind": k, "start": s, "end": e} for s, e, k in found]

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([spans(t) for t in texts])

    return docs.withColumn(out, find(F.col(text)))


def redact(docs: DataFrame, *, text: str = "text", spans: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """docs with the text's spans replaced by mark (overlapping spans by one); rows without spans, null texts included, stay as they are."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, xs in zip(texts, found, strict=True):
            if t is not None and xs is not None and len(xs):
                parts, at = [], 0
                for x in xs:
                    if x["start"] >= at:
                        parts += [t[at : x["start"]], mark]
                    at = max(at, x["end"])
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, F.when(F.size(spans) > 0, cut(F.col(text), F.col(spans))).otherwise(F.col(text)))
