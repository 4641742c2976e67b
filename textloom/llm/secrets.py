"""Secret scan by grammar inference.

What the base rules find are labelled credentials: their kind is their label. From a bounded sample of them, a prefix tree is built
for each kind and its statistically compatible states are merged (the ALERGIA rule, with Hoeffding's bound) into a probabilistic
automaton: a distribution over all strings, lengths included. Every other run of credential characters, in every text, is scored by
how much likelier it is under each automaton than among ordinary runs; a run beyond a fixed ratio is a finding of that kind too.
Ordinary runs are a mixture of a character-pair model, counted over all runs of all texts, and of plain digits and letters.

The texts are read twice: once for what is learned from them (credentials and pair counts, summed by Spark), once to scan them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

# The base rules.
ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: No labelled credential is shorter, so shorter runs aren't candidates.
SHORTEST = min(LEAST.values())

#: The characters of credentials. A candidate is a maximal run of them outside base spans; within a run "=" stands at its end alone.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-="
#: Bytes to symbols: 1 and up for the alphabet, 0 for all else, which is also what stands before and after a run.
SYMBOL = np.zeros(256, np.int64)
SYMBOL[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
SYMBOLS = len(ALPHABET) + 1
RUN = SYMBOL > 0
RUN[ord("=")] = False

#: Labelled credentials of each kind that training reads: distinct ones in the order of a hash, and their characters in all.
SAMPLE, SAMPLE_CHARS, FEWEST = 2000, 1_000_000, 4
ALPHA = 0.3  # of the merging test
STRAY = 0.5  # weight, in visits, of what a state has never seen
#: A run is a finding if it is 1 / FALSE_ALARM times likelier under a grammar; of ordinary runs at most this share reaches that.
FALSE_ALARM = 1e-4
#: Scores of this many distinct runs, of up to this many characters each, are kept by a task.
KEPT, KEPT_CHARS = 200_000, 64


def runs(text: str, least: int = 1) -> list[tuple[int, int]]:
    """Start and end, in code points, of the maximal runs of at least `least` characters."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    inside = np.concatenate([[False], RUN[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if "=" in text:
        padding = np.concatenate([raw == ord("="), [False]])
        more = np.flatnonzero(padding[ends])
        after = np.flatnonzero(~padding)
        ends = ends.copy()
        ends[more] = after[np.searchsorted(after, ends[more])]
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return []
    if len(raw) == len(text):
        return list(zip(starts.tolist(), ends.tolist()))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return list(zip(points[starts].tolist(), points[ends].tolist()))


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the base rules."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    for s, e in runs(text, LEAST["hex"]):
        out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text, s, e) if m.end() - m.start() >= LEAST["hex"]]
    return out


def blanked(text: str, spans: list[tuple]) -> str:
    """The text with blanks in place of the spans, so that what is left of a run beside one is a run."""
    out, at = [], 0
    for _, s, e, *_ in sorted(spans, key=lambda x: x[1]):
        if e > at:
            out += [text[at : max(at, s)], " " * (e - max(at, s))]
            at = e
    return "".join(out) + text[at:] if out else text


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed; the grammar's kinds come after the base's."""
    order = {k: i for i, k in enumerate([*KINDS, *(f"grammar-{k}" for k in KINDS)])}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order[x[0]], x[2])))


# --- automata ------------------------------------------------------------------------------------------------------------


class Automaton:
    """A probabilistic automaton: visits and ends of each state, and by character the next state and how often it was taken.

    Each state gives STRAY visits to what it hasn't seen, shared out as characters and ends are in all samples; after such a
    character a run goes on by these shares alone. So the probabilities of all strings add up to one.
    """

    def __init__(self, samples: list[str]):
        self.visits, self.ends, self.next, self.taken = [0], [0], [{}], [{}]
        chars = Counter(ALPHABET)
        for s in samples:
            self._add(s)
            chars.update(s)
        every = chars.total() + len(samples) + 1
        self.share = {c: n / every for c, n in chars.items()}
        self.end_share = (len(samples) + 1) / every
        self._merge()

    def _add(self, word: str) -> None:
        at = 0
        self.visits[0] += 1
        for c in word:
            if c not in self.next[at]:
                self.next[at][c] = len(self.visits)
                for x, v in ((self.visits, 0), (self.ends, 0), (self.next, {}), (self.taken, {})):
                    x.append(v)
            self.taken[at][c] = self.taken[at].get(c, 0) + 1
            at = self.next[at][c]
            self.visits[at] += 1
        self.ends[at] += 1

    def _alike(self, a: int, b: int) -> bool:
        """Whether a and b, and what follows them, differ by no more than chance."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            bound = (1 / math.sqrt(n) + 1 / math.sqrt(m)) * math.sqrt(0.5 * math.log(2 / ALPHA))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if abs(self.taken[a].get(c, 0) / n - self.taken[b].get(c, 0) / m) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the tree's counts to the automaton from `into` on; branches that it lacks are hung on."""
        stack = [(into, tree)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.taken[b].items():
                self.taken[a][c] = self.taken[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self) -> None:
        """States that are settled, and those next to them, which are trees: each is merged into an alike settled state or settles."""
        settled = [0]
        known = {0}
        while True:
            edge = [(self.visits[t], -t, s, c) for s in settled for c, t in self.next[s].items() if t not in known]
            if not edge:
                break
            _, t, s, c = max(edge)
            for r in settled:
                if self._alike(r, -t):
                    self.next[s][c] = r
                    self._fold(r, -t)
                    break
            else:
                settled.append(-t)
                known.add(-t)
        self.states = len(settled)
        # What scoring needs of each settled state: the next state and the logarithm of each character, seen or stray, and of the end.
        lost = {c: (-1, math.log(p)) for c, p in self.share.items()}
        self.moves, self.stops = {-1: lost}, {-1: math.log(self.end_share)}
        for s in settled:
            below = self.visits[s] + STRAY
            self.moves[s] = {
                c: (self.next[s].get(c, -1), math.log((self.taken[s].get(c, 0) + STRAY * p) / below)) for c, p in self.share.items()
            }
            self.stops[s] = math.log((self.ends[s] + STRAY * self.end_share) / below)

    def likelihood(self, text: str) -> float:
        """log probability of the text, its end included. text: of ALPHABET."""
        at, total = 0, 0.0
        for c in text:
            at, x = self.moves[at][c]
            total += x
        return total + self.stops[at]


class Ordinary:
    """Ordinary runs: an equal mixture of the pair model and of digits, small letters and capitals, each alike and of any length."""

    PLAIN = (re.compile("[0-9]+"), 10), (re.compile("[a-z]+"), 26), (re.compile("[A-Z]+"), 26)
    STOP = 1 / 16  # probability that a plain run ends after a character

    def __init__(self, pairs: np.ndarray):
        """pairs: how often symbol follows symbol (SYMBOLS x SYMBOLS); 0, here a blank, before and after a run."""
        single = (pairs.sum(0) + 1) / (pairs.sum() + SYMBOLS)
        log = np.log((pairs + SYMBOLS * single) / (pairs.sum(1, keepdims=True) + SYMBOLS)).tolist()
        signs = " " + ALPHABET
        self.log = {a + b: log[i][j] for i, a in enumerate(signs) for j, b in enumerate(signs)}

    def likelihood(self, text: str) -> float:
        """log probability of the text, its end included. text: of ALPHABET."""
        parts = [sum(map(self.log.__getitem__, map(str.__add__, " " + text, text + " ")))]
        parts += [len(text) * math.log((1 - self.STOP) / n) + math.log(self.STOP) for form, n in self.PLAIN if form.fullmatch(text)]
        most = max(parts)
        return most + math.log(sum(math.exp(x - most) for x in parts) / (1 + len(self.PLAIN)))


def learn(samples: list[str]) -> Automaton | None:
    """The automaton of a kind; None with too few credentials to tell."""
    return Automaton(sorted(samples)) if len(samples) > FEWEST else None


class Judge:
    """Tells whether a run is a finding, and of which kind. The verdicts on short runs are kept, as runs repeat."""

    def __init__(self, grammars: dict[str, Automaton], ordinary: Ordinary):
        self.grammars, self.ordinary = grammars, ordinary
        self.kept: dict[str, str] = {}

    def kind(self, run: str) -> str:
        """The kind under which the run is likeliest, or none."""
        known = self.kept.get(run)
        if known is not None:
            return known
        best, kind = max((g.likelihood(run), k) for k, g in self.grammars.items())
        out = kind if best - self.ordinary.likelihood(run) >= -math.log(FALSE_ALARM) else ""
        if len(run) <= KEPT_CHARS:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            self.kept[run] = out
        return out

    def spans(self, text: str, base: list[tuple]) -> list[tuple[str, int, int]]:
        """Every run outside the base spans, of SHORTEST characters and up, that is likely enough; its length is the grammar's to judge."""
        if not self.grammars:
            return []
        rest = blanked(text, base)
        return [(f"grammar-{k}", s, e) for s, e in runs(rest, SHORTEST) if (k := self.kind(rest[s:e]))]


# --- Spark ---------------------------------------------------------------------------------------------------------------

PAIRS = "pairs"


def pair_counts(text: str) -> np.ndarray:
    """How often each pair of symbols (their numbers as one) stands in the runs of the text, their ends included."""
    s = np.concatenate([[0], SYMBOL[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], [0]])
    pair = s[:-1] * SYMBOLS + s[1:]
    return np.bincount(pair[pair > 0], minlength=SYMBOLS * SYMBOLS)


def learned_from(docs: DataFrame) -> DataFrame:
    """(kind, what, n): the distinct credentials of the base rules, and, as kind PAIRS, how often each pair stands outside them."""

    def run(batches):
        pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            found: Counter = Counter()
            for t in batch.column(0):
                text = t.as_py() or ""
                base = base_spans(text)
                found.update((k, c) for k, _, _, c in base)
                pairs += pair_counts(blanked(text, base))
            kinds, texts = [k for k, _ in found], [c for _, c in found]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(texts, pa.string()), pa.array(list(found.values()), pa.int64())], ["kind", "what", "n"])
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array([PAIRS] * len(some), pa.string()), pa.array([str(x) for x in some.tolist()], pa.string()), pa.array(pairs[some])], ["kind", "what", "n"])

    rows = docs.select("text").mapInArrow(run, "kind string, what string, n bigint")
    return save(rows.groupBy("kind", "what").agg(F.sum("n").alias("n")), "credentials")


def judge_of(learned: DataFrame) -> Judge:
    """The grammars, from SAMPLE credentials and SAMPLE_CHARS characters of a kind at most, and the ordinary runs (SYMBOLS^2 numbers)."""
    grammars = {}
    for kind in KINDS:
        of_kind = learned.filter(F.col("kind") == kind)
        order = [F.xxhash64("what"), F.sha1("what")]
        first = of_kind.select(F.sha1("what").alias("id"), F.char_length("what").alias("chars"), *(x.alias(f"o{i}") for i, x in enumerate(order))).orderBy("o0", "o1").limit(SAMPLE)
        ids, left = [], SAMPLE_CHARS
        for r in first.collect():
            if r.chars <= left:  # one that is too long for what is left is passed over, the next ones may fit
                ids.append(r.id)
                left -= r.chars
        rows = of_kind.filter(F.sha1("what").isin(ids)).select("what").collect() if ids else []
        if made := learn([r.what for r in rows]):
            grammars[kind] = made
    pairs = np.zeros(SYMBOLS * SYMBOLS)
    for r in learned.filter(F.col("kind") == PAIRS).collect():
        pairs[int(r.what)] = r.n
    return Judge(grammars, Ordinary(pairs.reshape(SYMBOLS, SYMBOLS)))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts have no spans (base_sha256 is then that of the empty text). Offsets count code points. Grammar spans are
    listed as grammar-<kind> and overlap no base span. Without credentials of a kind to learn from it adds none. Repeated rows are
    scanned alike, and other columns aren't read.
    """
    judge = docs.sparkSession.sparkContext.broadcast(judge_of(learned_from(docs)))

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for t in batch.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                spans = [(k, s, e) for k, s, e, _ in base]
                more = judge.value.spans(text, base)
                for col, kind in zip(cols, KINDS):
                    col.append(sum(k == kind for k, _, _ in spans))
                cols[3].append(hashlib.sha256(listed(spans).encode()).hexdigest())
                cols[4].append(listed(spans + more))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
