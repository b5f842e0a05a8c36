r"""Secret scan: fixed rules, and grammars inferred from labelled credentials.

The base rules find assignments, access keys and long hexadecimal strings. The learned
part takes labelled credentials (given, or made by `examples` from publicly documented
formats), builds a prefix tree of each kind, and merges states whose outgoing
frequencies do not differ beyond a Hoeffding bound, subtree by subtree. The result is a
probabilistic automaton for each kind. Every maximal run of credential characters is
then scored by each automaton against the likeliest of several backgrounds (words, numbers,
rules); runs that an
automaton accepts with enough likelihood a character become further spans. Where a run as
a whole is none (a credential behind a name, a path or a prefix), its parts are scored:
those that begin with a kind's literal start, or for kinds without one behind a separator,
and that end before a separator with a length between those of the kind's labelled
credentials, or at the end of the run with at least the least of these.

Symbols are the characters themselves at the first `LITERAL` places, where formats keep
their markers, and character classes after them.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from civitas.llm.common import column

# The base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "learned")
HINTS = ("passw", "secret", "token", "apikey", "api_key")

SEPARATORS = "+/_.=-"
#: The least length of a run that is scored as a whole, unless labelled credentials are shorter.
WHOLE = 16
LITERAL = 4
#: Log-likelihood ratio a character that makes a span.
THRESHOLD = 0.5
END = "$"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules' matches in order of start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


# Publicly documented credential formats, as (literal start, alphabet, lengths).
FORMATS = {
    "github": ("ghp_", string.ascii_letters + string.digits, (36,)),
    "google": ("AIza", string.ascii_letters + string.digits + "_-", (35,)),
    "stripe": ("sk_live_", string.ascii_letters + string.digits, (24,)),
    "slack": ("xoxb-", string.digits + "-" + string.ascii_letters, (40, 50)),
    "gitlab": ("glpat-", string.ascii_letters + string.digits + "_-", (20,)),
    "npm": ("npm_", string.ascii_letters + string.digits, (36,)),
    "jwt": ("eyJhbGciOi", string.ascii_letters + string.digits + "_-.", (80, 140)),
    "aws_secret": ("", string.ascii_letters + string.digits + "/+", (40,)),
}


def examples(n: int = 150, seed: int = 11) -> list[tuple[str, str]]:
    """Labelled credentials (kind, text), made by rule."""
    rng = random.Random(seed)
    return [(kind, start + "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))) for kind, (start, letters, sizes) in FORMATS.items() for _ in range(n)]


def symbols(text: str, literal: int) -> list[str]:
    return list(text[:literal]) + [_class(c) for c in text[literal:]] + [END]


def _class(c: str) -> str:
    if c.isdigit():
        return "digit"
    if c.islower():
        return "lower-hex" if c <= "f" else "lower"
    if c.isupper():
        return "upper-hex" if c <= "F" else "upper"
    return c


class _State:
    __slots__ = ("next", "count", "out", "depth")

    def __init__(self, depth: int = 0):
        self.next: dict[str, _State] = {}
        self.out: dict[str, int] = {}
        self.count = 0
        self.depth = depth


def _tree(words: list[list[str]]) -> _State:
    root = _State()
    for word in words:
        at = root
        for s in word:
            at.count += 1
            at.out[s] = at.out.get(s, 0) + 1
            if s != END:
                at = at.next.setdefault(s, _State(at.depth + 1))
    return root


def _differ(f1: int, n1: int, f2: int, n2: int, alpha: float) -> bool:
    return abs(f1 / n1 - f2 / n2) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def _compatible(a: _State, b: _State, alpha: float) -> bool:
    todo, seen = [(a, b)], set()
    while todo:
        x, y = todo.pop()
        if (id(x), id(y)) in seen or not x.count or not y.count:
            continue
        seen.add((id(x), id(y)))
        for s in {*x.out, *y.out}:
            if _differ(x.out.get(s, 0), x.count, y.out.get(s, 0), y.count, alpha):
                return False
            if s in x.next and s in y.next:
                todo.append((x.next[s], y.next[s]))
    return True


def _fold(into: _State, tree: _State) -> None:
    """Add a subtree's counts to an automaton's states, growing it where it has none."""
    todo = [(into, tree)]
    while todo:
        x, y = todo.pop()
        x.count += y.count
        for s, n in y.out.items():
            x.out[s] = x.out.get(s, 0) + n
        for s, child in y.next.items():
            if s in x.next:
                todo.append((x.next[s], child))
            else:
                x.next[s] = child


@dataclass
class Automaton:
    """moves[state][symbol] = (next state, log probability)."""

    kind: str
    literal: int
    moves: list[dict[str, tuple[int, float]]]
    #: The common start of the labelled credentials (as far as it is literal), and their least and greatest length.
    start: str = ""
    least: int = WHOLE
    most: int = WHOLE

    def ratio(self, text: str, background: tuple[dict[str, float], ...]) -> float:
        """Mean log-likelihood ratio a character to the likeliest background, or -inf if not accepted."""
        at, total = 0, 0.0
        for s in symbols(text, self.literal):
            move = self.moves[at].get(s)
            if move is None:
                return -math.inf
            at = move[0]
            total += move[1]
        classes = [_class(c) for c in text]
        return (total - max(sum(b.get(c, -5.0) for c in classes) for b in background)) / len(text)


def infer(kind: str, words: list[str], literal: int = LITERAL, alpha: float = 0.05) -> Automaton:
    """Merge compatible states of the prefix tree, nearest the root first.

    States before the last literal place stay apart, as they emit characters and not classes.
    What a state has not seen of the classes that others have is as likely as half an occurrence.
    """
    root = _tree([symbols(w, literal) for w in words])
    red: list[_State] = [root]
    edges = [(root, s) for s in sorted(root.next)]
    while edges:
        parent, s = edges.pop(0)
        child = parent.next[s]
        if any(child is r for r in red):
            continue
        for r in red:
            if min(r.depth, child.depth) >= literal and _compatible(r, child, alpha):
                before = {id(r): set(r.next) for r in red}
                parent.next[s] = r
                _fold(r, child)
                edges += [(q, t) for q in red for t in sorted(set(q.next) - before[id(q)])]
                break
        else:
            red.append(child)
            edges += [(child, t) for t in sorted(child.next)]
    number = {id(r): i for i, r in enumerate(red)}
    loose = [r for r in red if r.depth >= literal]
    usual = number[id(max(loose, key=lambda r: r.count))] if loose else 0
    known = {s for r in loose for s in r.out if s != END}
    moves = []
    for r in red:
        own = {}
        for s, n in r.out.items():
            to = 0 if s == END else number.get(id(r.next[s]))
            if to is not None:
                own[s] = (to, math.log(n / r.count))
        if r.depth >= literal:
            own |= {s: (usual, math.log(0.5 / (r.count + 1))) for s in known if s not in own}
        moves.append(own)
    return Automaton(kind, literal, moves, words[0][:literal], min(map(len, words)), max(map(len, words)))


def _logs(**shares: float) -> dict[str, float]:
    rest = {"lower": 0.01, "lower-hex": 0.01, "upper": 0.01, "upper-hex": 0.01, "digit": 0.01, "-": 0.01, ".": 0.01, "_": 0.005, "/": 0.004, "=": 0.001, "+": 0.001}
    return {k: math.log(v) for k, v in (rest | {k.replace("_hex", "-hex"): v for k, v in shares.items()}).items()}


#: Log frequencies of classes in what is no credential: words, words in capitals, numbers, rules of symbols.
BACKGROUND = (
    _logs(lower=0.62, lower_hex=0.3, upper=0.02, digit=0.02),
    _logs(upper=0.65, upper_hex=0.29),
    _logs(digit=0.93),
    _logs() | {k: math.log(0.15) for k in "-._/=+"},
)


def train(labelled: list[tuple[str, str]]) -> list[Automaton]:
    """One automaton for each kind; kinds without a common start have no literal places."""
    by: dict[str, list[str]] = {}
    for kind, text in labelled:
        by.setdefault(kind, []).append(text)
    return [infer(k, w, LITERAL if len({x[:LITERAL] for x in w}) == 1 else 0) for k, w in sorted(by.items())]


def candidates(automata: list[Automaton]) -> re.Pattern:
    """Maximal runs of credential characters as long as the shortest that may be accepted."""
    least = min([WHOLE, *(a.least for a in automata)])
    return re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_.=-]{%d,}[A-Za-z0-9+/_=-])" % max(least - 2, 0))


def _tails(a: Automaton, classes: list[str], places: list[int]) -> dict[int, list[float]]:
    """For each place the log probability of the rest of the run from each state, in one pass from the end."""
    wanted, out = set(places), {}
    rest = [m[END][1] if END in m else -math.inf for m in a.moves]
    for i in range(len(classes), -1, -1):
        if i < len(classes):
            steps = [m.get(classes[i]) for m in a.moves]
            rest = [-math.inf if s is None else s[1] + rest[s[0]] for s in steps]
        if i in wanted:
            out[i] = rest
    return out


def _parts(run: str, a: Automaton, classes: list[str], sums: list[list[float]]) -> list[tuple[int, int]]:
    """(start, end) of the parts of a run that an automaton accepts: the longest for each start."""
    last, places = len(run) - a.least, []
    if a.start:
        at = run.find(a.start)
        while -1 < at <= last:
            places.append(at)
            at = run.find(a.start, at + 1)
    else:
        # A format without a beginning of its own is looked for up to the end of its run alone, in addresses only as a value: else parts of paths and of encoded data would do.
        separators = "=" if run.startswith("//") else SEPARATORS
        places = [i for i in range(max(0, len(run) - a.most), last + 1) if i == 0 or run[i - 1] in separators]
    if not places:
        return []
    good = lambda i, j, total: total - max(s[j] - s[i] for s in sums) >= THRESHOLD * (j - i)
    far = [i + a.literal for i in places if len(run) - i > a.most]
    tails = _tails(a, classes, far) if far else {}
    out = []
    for i in places:
        state, total, best = 0, 0.0, None
        for j in range(i, min(len(run), i + a.most) + 1):
            if j - i == a.literal and j in tails and good(i, len(run), total + tails[j][state]):
                best = len(run)
                break
            end = a.moves[state].get(END)
            if end and j - i >= a.least and (j == len(run) or a.start and run[j] in SEPARATORS) and good(i, j, total + end[1]):
                best = j
            if j == len(run) or (move := a.moves[state].get(run[j] if j - i < a.literal else classes[j])) is None:
                break
            state, total = move[0], total + move[1]
        if best:
            out.append((i, best))
    return out


def learned_spans(text: str, automata: list[Automaton], taken: list[tuple[int, int, int]], pattern: re.Pattern | None = None) -> list[tuple[int, int, int]]:
    """Accepted candidates, or else accepted parts of them, that overlap no base span and no other."""
    out = []
    ends = [(s, e) for s, _, e in taken]
    for m in (pattern or candidates(automata)).finditer(text):
        run, at = m.group(), m.start()
        near = [(s - at, e - at) for s, e in ends if s < m.end() and at < e]
        if not near and max((a.ratio(run, BACKGROUND) for a in automata if len(run) >= min(WHOLE, a.least) and (a.start or len(run) <= a.most)), default=-math.inf) >= THRESHOLD:
            out.append((at, 3, m.end()))
            continue
        some = [a for a in automata if len(run) >= a.least and (a.start in run if a.start else any(c in SEPARATORS for c in run))]
        if not some:
            continue
        classes = [_class(c) for c in run]
        sums = [[0.0, *itertools.accumulate(b.get(c, -5.0) for c in classes)] for b in BACKGROUND]
        free = 0
        for i, j in sorted((p for a in some for p in _parts(run, a, classes, sums)), key=lambda p: (p[0], -p[1])):
            if i >= free and not any(s < j and i < e for s, e in near):
                out.append((at + i, 3, at + j))
                free = j
    return out


def scan(docs: DataFrame, automata: list[Automaton]) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_learned, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, ordered by start, then kind as
    in KINDS, joined by commas. A null text counts as empty and, like any text without
    matches, has zero counts, the digest of the empty string and empty spans. Repeated rows
    are returned as often; other columns are ignored; an empty table gives no row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    pattern = candidates(automata)

    def find(batches):
        import pyarrow as pa

        joined = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, digests, shown = np.zeros((part.num_rows, 4), np.int64), [], []
                for i, text in enumerate(column(part, "text")):
                    text = text.as_py() or ""
                    base = base_spans(text)
                    more = learned_spans(text, automata, base, pattern)
                    for _, k, _ in base + more:
                        counts[i, k] += 1
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    shown.append(joined(sorted(base + more)))
                yield pa.record_batch([column(part, "doc_id"), *(pa.array(counts[:, k]) for k in range(4)), pa.array(digests), pa.array(shown)], ["doc_id", "n_assign", "n_access", "n_hex", "n_learned", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_learned long, base_sha256 string, spans string")
