"""Secret scan: fixed patterns, and formats learned as probabilistic automata.

Labelled credentials make a prefix tree with counts. Its states are merged, nearest to the root first, wherever the Hoeffding bound calls
their futures compatible; what remains is a probabilistic automaton of the formats. Labelled ordinary tokens make a
second one. Every candidate token of every text is scored by the difference of its mean log likelihoods. The automata have a bounded size
and travel with the tasks; scanning is one pass without a shuffle.
"""

from __future__ import annotations

import math
import random
import re
import string
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import body, session

# Kinds in order with their pattern, and the least length of the part that counts
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "format")
LEAST = {"assign": 6, "access": 20, "hex": 24}

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LIMIT = 0.25                 # mean log-likelihood ratio a character from which a candidate is a secret
ALPHA = 0.05                 # of the Hoeffding bound
PER_FORMAT, WORDS_EACH = 24, 60
MOST_LABELLED = 2_000        # tokens of each label that are learned from a given table
ALNUM, B64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"

# Labelled formats: (prefix, alphabet, length of the random part). Examples are drawn with a fixed seed.
FORMATS = (("ghp_", ALNUM, 36), ("gho_", ALNUM, 36), ("glpat-", ALNUM + "_-", 20), ("sk_live_", ALNUM, 24), ("rk_live_", ALNUM, 24), ("npm_", ALNUM, 36),
           ("AIza", ALNUM + "_-", 35), ("xoxb-", string.digits, 12), ("SG_", ALNUM + "_-", 43), ("AKIA", string.ascii_uppercase + string.digits, 16),
           ("", string.digits + "abcdef", 32), ("", string.digits + "abcdef", 40), ("", B64, 40), ("", ALNUM, 32))
SYLLABLES = ("the", "ing", "tion", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar", "st", "to", "nt", "ent", "ment",
             "que", "aux", "eau", "ung", "keit", "lich", "sch", "ver", "ge", "heit", "os", "as", "ado", "mente", "cion", "ra", "do", "ll")


def labelled_tokens() -> tuple[list[str], list[str]]:
    """Examples of credentials and of ordinary long tokens: words, joined words, numbers, dates, paths."""
    r = random.Random(7)
    pick = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    word = lambda a, b: "".join(r.choice(SYLLABLES) for _ in range(r.randint(a, b)))
    good = [p + pick(alphabet, n) for p, alphabet, n in FORMATS for _ in range(PER_FORMAT)]
    plain = [f() for f in (lambda: word(5, 9), lambda: word(5, 9).capitalize(), lambda: word(5, 9).upper(), lambda: "-".join(word(1, 3) for _ in range(4)),
                           lambda: "_".join(word(1, 3) for _ in range(4)), lambda: "/".join(word(1, 3) for _ in range(4)), lambda: pick(string.digits, r.randint(16, 20)),
                           lambda: f"20{pick(string.digits, 2)}-0{pick('123456789', 1)}-1{pick(string.digits, 1)}-{pick(string.digits, 6)}",
                           lambda: word(4, 7) + pick(string.digits, 4), lambda: r.choice("-=_") * r.randint(16, 40)) for _ in range(WORDS_EACH)]
    return good, plain


def symbol(c: str) -> str:
    """Characters by class: the automata learn formats, not single random letters."""
    if c in "abcdef":
        return "a"
    if "g" <= c <= "z":
        return "z"
    if c in "ABCDEF":
        return "A"
    if "G" <= c <= "Z":
        return "Z"
    return "0" if "0" <= c <= "9" else c


SIZE = {"a": 6, "z": 20, "A": 6, "Z": 20, "0": 10}
SYMBOLS = {c: symbol(c) for c in ALNUM + "+/_=-."}


class Automaton:
    """Prefix tree of labelled tokens, merged into a probabilistic automaton."""

    def __init__(self, tokens: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]          # by symbol; "" counts ends
        for t in tokens:
            at = 0
            for c in t:
                s = SYMBOLS.get(c) or symbol(c)
                self.count[at][s] = self.count[at].get(s, 0) + 1
                if s not in self.next[at]:
                    self.next[at][s] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                at = self.next[at][s]
            self.count[at][""] = self.count[at].get("", 0) + 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self.table = self._logs()

    def _differ(self, a: int, b: int) -> bool:
        x, y = self.count[a], self.count[b]
        n, m = sum(x.values()), sum(y.values())
        if not n or not m:
            return False
        bound = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return any(abs(x.get(s, 0) / n - y.get(s, 0) / m) > bound for s in {*x, *y})

    def _compatible(self, a: int, b: int) -> bool:
        """No symbol's frequency differs beyond the bound, here or further on."""
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            if pair in seen:
                continue
            seen.add(pair)
            if self._differ(*pair):
                return False
            todo += [(self.next[pair[0]][s], self.next[pair[1]][s]) for s in self.next[pair[0]].keys() & self.next[pair[1]].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree under ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            for s, n in self.count[y].items():
                self.count[x][s] = self.count[x].get(s, 0) + n
            for s, child in self.next[y].items():
                if s in self.next[x]:
                    todo.append((self.next[x][s], child))
                else:
                    self.next[x][s] = child

    def _merge_states(self) -> None:
        fixed, place = [0], 0
        while place < len(fixed):
            state = fixed[place]
            for s in sorted(self.next[state]):
                child = self.next[state][s]
                if child in fixed:
                    continue
                for other in fixed:
                    if self._compatible(other, child):
                        self.next[state][s] = other
                        self._fold(other, child)
                        break
                else:
                    fixed.append(child)
            place += 1
            # folding may have given a fixed state new branches: they are looked at again
            if place == len(fixed):
                known = set(fixed)
                place = next((i for i, f in enumerate(fixed) if any(c not in known for c in self.next[f].values())), place)
        self.states = fixed

    def _logs(self) -> dict[tuple[int, str], tuple[float, int]]:
        out = {}
        for q in self.states:
            total = sum(self.count[q].values()) + 1
            for s, n in self.count[q].items():
                out[q, s] = (math.log(n / total / SIZE.get(s, 1)), self.next[q].get(s, q))
            out[q, "?"] = (math.log(1 / total / 64), q)
        return out

    def score(self, token: str) -> float:
        """Mean log likelihood of a character; what a state has not seen costs its unseen share."""
        table, at, total = self.table, 0, 0.0
        for c in token:
            step = table.get((at, SYMBOLS.get(c) or symbol(c))) or table[at, "?"]
            total += step[0]
            at = step[1]
        total += (table.get((at, "")) or table[at, "?"])[0]
        return total / (len(token) + 1)


@lru_cache
def default_automata() -> tuple[Automaton, Automaton]:
    good, plain = labelled_tokens()
    return Automaton(good), Automaton(plain)


def learn(labelled: DataFrame, most: int = MOST_LABELLED, alpha: float = ALPHA) -> tuple[Automaton, Automaton]:
    """Automata of credentials and of other tokens from a labelled table (``token``, ``secret``: 1 or 0), for ``scan``.

    At most ``most`` tokens of each label are learned, chosen by a hash of the token; null and empty tokens and labels that are neither
    teach nothing, rows that repeat count once each. A label without tokens gives an automaton without a format: every character is unseen.
    """
    rows = labelled.select(F.col("token").alias("token"), F.col("secret").cast("int").alias("secret")).where("length(token) > 0")
    order = [F.xxhash64("token"), "token"]
    good, plain = ([r.token for r in rows.where(F.col("secret") == k).orderBy(*order).limit(most).collect()] for k in (1, 0))
    return Automaton(good, alpha), Automaton(plain, alpha)


def find(text: str, automata: tuple[Automaton, Automaton], limit: float = LIMIT) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, score) by start, then kind."""
    out: list[tuple[str, int, int, float | None]] = [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end(), None) for m in _LONG_HEX.finditer(text)]
    known: list[list[int]] = []                                # stretches of fixed patterns that overlap or touch
    for _, a, b, _ in sorted(out, key=lambda x: x[1]):
        if known and a <= known[-1][1]:
            known[-1][1] = max(known[-1][1], b)
        else:
            known.append([a, b])
    good, plain = automata
    place = 0                                                  # candidates and stretches both come in order
    for m in CANDIDATE.finditer(text):
        while place < len(known) and known[place][1] < m.end():
            place += 1
        if place < len(known) and known[place][0] <= m.start():     # wholly in fixed patterns
            continue
        ratio = good.score(m.group()) - plain.score(m.group())
        if ratio >= limit:
            out.append(("format", m.start(), m.end(), ratio))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


_LONG_HEX = re.compile("[0-9a-f]{%d,}" % LEAST["hex"])          # a run is maximal either way
FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])


def _scan(automata, limit):
    def run(batches):
        for rows in W.gather(batches, 1 << 20):
            spans = [[dict(zip(("kind", "start", "end", "score"), x)) for x in find(r[1].decode(), automata, limit)] for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(spans, FOUND.field("spans").type)], schema=FOUND)
    return run


def scan(docs: DataFrame, automata: tuple[Automaton, Automaton] | None = None, limit: float = LIMIT) -> DataFrame:
    """``doc_id, spans`` for every row: array of (kind, start, end, score) by start, then kind; code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are the fixed patterns; ``format`` are tokens that the automata call credentials and that are not
    wholly covered by them.
    Null and empty texts have no spans. Repeated rows and null ids are scanned each by itself. Only ``doc_id`` and ``text`` are read.
    """
    session(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("body"))
    return rows.mapInArrow(_scan(automata or default_automata(), limit), "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>")
