"""Secrets in texts: base patterns and a linear-chain conditional random field.

The field tags tokens as begin, inside or outside of a secret. A token's
features are its shape (character classes, length, entropy), the tokens
around it and features of the whole file; the best tag sequence is found by
Viterbi. It is trained in numpy by maximum likelihood on a bounded sample of
documents, whose tags come from the base patterns. Each segment with a value
is also learned with the value drawn anew from the alphabets that keys are
written in, once in its context and once with neutral words in the place of
the key words, so that the field finds values that no pattern names.

Every token of a text is scored and tagged, as one sequence from the first to
the last. Of an ordinary token the scores alone, with those of the token after
it, often show that it is outside on the best path whatever the tags around
it are (``_surely_outside``); the sequence falls apart there and Viterbi runs
over what lies between, with the result of a run over the whole text.

The field learns from a bounded part of the sampled texts. A word is *hot* if
it holds a digit, one of ``=:_+/@\\``, a key word, an upper-case letter after a
lower-case one or at least ``LONG`` characters; a segment is a hot word with
``AROUND`` words on either side (overlapping ones are one segment). All
segments of a sampled text are learned, and of one text in ``EVERY`` (by a hash
of the text) also a stretch of ``PLAIN`` words between them.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import by_text
from airshed.llm.sampling import bounded_sample

# fixed values: the base patterns and their least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "crf")
BASE_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KEY_WORDS = (*BASE_WORDS, "pwd", "credential", "bearer", "authorization", "private")

SAMPLE = 20_000                # documents the field is fitted on, about
LONG, AROUND, PLAIN, EVERY = 20, 2, 16, 16
DIM, WIDTH = 1 << 13, 18       # hashed features: table size, features a token
EPOCHS, RATE, RIDGE = 60, 0.15, 1e-4
KEPT, SHORT = 200_000, 64      # tokens that a task remembers, and their length
O, B, I = 0, 1, 2

_TOKEN = re.compile(r"""[^\s"':=|,;()<>{}\[\]]+|["':=]""")
_HOT = np.zeros(129, dtype=bool)
_HOT[[*range(48, 58), *map(ord, "=:_+/@\\")]] = True
_HEX = np.zeros(129, dtype=bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True


def _points(text: str) -> np.ndarray:
    """Code points, those from 128 on as 128."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), 128)


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def _lowered(text: str) -> str:
    """Lower case of the same length (a few letters' lower case is longer:
    then only A-Z are changed)."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_ASCII_LOWER)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    return edge[::2], edge[1::2]


def base_spans(text: str, code: np.ndarray, low: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base patterns' matches,
    by start, then kind."""
    out = []
    if any(w in low for w in BASE_WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    start, end = _runs(_HEX[code])
    out += [(int(s), 2, int(e), int(s)) for s, e in zip(start, end) if e - s >= HEX_LEAST] if (
        len(start) and (end - start).max() >= HEX_LEAST) else []
    return sorted(out)


def segments(code: np.ndarray, low: str) -> list[tuple[int, int]]:
    """Ranges of code points around hot words."""
    start, end = _runs(code > 32)
    if not len(start):
        return []
    hot = end - start >= LONG
    turns = np.concatenate([[False], (code[:-1] >= 97) & (code[:-1] <= 122) & (code[1:] >= 65) & (code[1:] <= 90)])
    marks = np.flatnonzero(_HOT[code] | turns)
    if len(marks):
        hot[np.searchsorted(start, marks, side="right") - 1] = True
    for word in KEY_WORDS:
        at = low.find(word)
        while at >= 0:
            hot[np.searchsorted(start, at, side="right") - 1] = True
            at = low.find(word, at + 1)
    at = np.flatnonzero(hot)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * AROUND)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    return [(int(start[max(0, at[f] - AROUND)]), int(end[min(len(end) - 1, at[t] + AROUND)])) for f, t in zip(first, last)]


def _shape(token: str) -> str:
    out = []
    for c in token[:200]:
        k = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c if c < "\x80" else "?"
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:6]) + ("~" if len(out) > 6 else "")


def _bin(n: float, edges=(1, 2, 3, 5, 8, 12, 16, 20, 24, 32, 40, 64)) -> int:
    return sum(n >= e for e in edges)


def file_features(text: str, code: np.ndarray, n_segments: int) -> list[str]:
    n = max(1, len(code))
    digits = float(((code >= 48) & (code < 58)).mean()) if len(code) else 0.0
    return [f"f0{_bin(digits * 1000, (1, 5, 20, 50, 200))}", f"f1{_bin(n, (100, 1000, 10_000, 100_000))}",
            f"f2{_bin(1000 * n_segments / n, (0.2, 1, 5, 20))}", f"f3{_bin(text.count('=') / n * 1000, (0.1, 1, 5))}"]


_HEX_LETTERS = "0123456789abcdefABCDEF"
_entropies: dict[tuple[int, ...], int] = {}


def _entropy(t: str) -> int:
    """Twice the entropy of its characters, rounded down."""
    counts = tuple(sorted(Counter(t).values() if len(t) > SHORT else map(t.count, set(t))))
    if (found := _entropies.get(counts)) is None:
        found = int(-2 * sum(c / len(t) * math.log2(c / len(t)) for c in counts))
        if len(t) <= SHORT and len(_entropies) < KEPT:
            _entropies[counts] = found
    return found


def _traits(t: str) -> tuple:
    """What the features of a token that no other token changes are made of;
    the last of it is its class."""
    n = len(t)
    if t.isascii() and t.isalpha() and t.islower():
        shape, digits, uppers = "a", 0, 0
    else:
        shape, digits, uppers = _shape(t), sum(map(str.isdigit, t)), sum(map(str.isupper, t))
    low = t.lower()
    own = next((w for w in KEY_WORDS if w in low), None) if n > 2 else None
    return (shape, _bin(n), _entropy(t), digits * 5 // n, uppers * 5 // n, digits > 0, uppers > 0, not t.strip(_HEX_LETTERS),
            own or (t if n == 1 and not t.isalnum() else shape[:3]))


def _own_names(traits: tuple) -> list[str]:
    shape, size, e, digits, uppers, has_digit, has_upper, hexed, own = traits
    return ["b", f"s{shape}", f"n{size}", f"e{e}", f"d{digits}", f"u{uppers}", f"h{hexed}{size}",
            f"c{own}", f"z{int(has_digit)}{int(has_upper)}{size}{e}"]


def _around_names(p2: str, p1: str, n1: str, n2: str) -> list[str]:
    """The features of the two classes before a token and the two after it."""
    return [f"p{p1}", f"q{p2}", f"r{p1}|{p2}", f"x{n1}", f"y{n2}"]


def _places(names: list[str]) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % DIM for x in names]


def token_features(tokens: list[str], whole: list[str]) -> np.ndarray:
    """(tokens, WIDTH) rows of hashed features."""
    own = [_traits(t) for t in tokens]
    classes = ["<", "<", *(x[-1] for x in own), ">", ">"]
    out = np.empty((len(tokens), WIDTH), dtype=np.int32)
    for i, traits in enumerate(own):
        p2, p1, _, n1, n2 = classes[i:i + 5]
        out[i] = _places([*_own_names(traits), *_around_names(p2, p1, n1, n2), *whole])
    return out


def plain_stretch(text: str, code: np.ndarray, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """At most ``PLAIN`` words that no segment holds: of the longest gaps
    between segments (up to 16), one drawn by a hash of the text."""
    edges = [0, *(x for r in ranges for x in r), len(code)]
    gaps = sorted((s - e, s, e) for s, e in zip(edges[::2], edges[1::2]) if e > s)[:16]
    if not gaps:
        return []
    drawn = zlib.crc32(text.encode("utf-8", "surrogatepass")) // EVERY
    _, s, e = gaps[drawn % len(gaps)]
    start, end = _runs(code[s:e] > 32)
    if not len(start):
        return []
    first = (drawn >> 4) % max(1, len(start) - PLAIN + 1)
    return [(s + int(start[first]), s + int(end[min(len(end), first + PLAIN) - 1]))]


def _segment_rows(text: str):
    """(tokens as (start, end), features, base spans that reach into it, file
    features) of each segment of a text, in some with a stretch beside them."""
    code, low = _points(text), _lowered(text)
    base = base_spans(text, code, low)
    ranges = segments(code, low)
    whole = file_features(text, code, len(ranges))
    near, at = [], 0
    drawn = zlib.crc32(text.encode("utf-8", "surrogatepass")) % EVERY == 0
    for s, e in sorted(ranges + (plain_stretch(text, code, ranges) if drawn else [])):
        near = [b for b in near if b[2] > s]
        while at < len(base) and base[at][0] < e:
            near.append(base[at])
            at += 1
        found = [(s + m.start(), s + m.end()) for m in _TOKEN.finditer(text[s:e])]
        if found:
            yield found, token_features([text[x:y] for x, y in found], whole), list(near), whole


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = (_DIGITS + "ABCDEF", _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _DIGITS, _DIGITS + "abcdef")


def _redrawn(tokens: list[str], tag: np.ndarray) -> Iterator[list[str]]:
    """The tokens with other values, in their context and without key words."""
    rng = np.random.default_rng(zlib.crc32(" ".join(tokens).encode("utf-8", "surrogatepass")))

    def value() -> str:
        letters = _ALPHABETS[int(rng.integers(len(_ALPHABETS)))]
        body = "".join(rng.choice(list(letters), int(rng.integers(6, 56)))) + "7aA"[int(rng.integers(3))] + "3"
        return "".join(rng.choice(list(_LOWER), 2)) + "_" + body if rng.random() < 0.2 else body

    for neutral in (False, True):
        out = []
        for t, k in zip(tokens, tag):
            plain = neutral and (t in "=:" or any(w in t.lower() for w in KEY_WORDS))
            out.append(value() if k else "the" if plain else t)
        yield out


def _training(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        feats, tags = [], []
        for text in pdf["text"]:
            if not text:
                continue
            for found, rows, base, whole in _segment_rows(text):
                tag = np.zeros(len(found), dtype=np.int8)
                starts, ends = [x for x, _ in found], [y for _, y in found]
                for _, _, end, value in base:
                    first, past = bisect_right(ends, value), bisect_left(starts, end)
                    tag[first:past] = I
                    tag[first:min(first + 1, past)] = B
                versions = [rows]
                if tag.any():
                    tokens = [text[x:y] for x, y in found]
                    versions += [token_features(v, whole) for v in _redrawn(tokens, tag)]
                for v in versions:
                    feats.append(v.astype("<i4").tobytes())
                    tags.append(tag.tobytes())
        yield pd.DataFrame({"features": feats, "tags": tags})


class Field:
    """Weights of the features by tag and of the transitions between tags."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move
        self._forget()

    def __getstate__(self) -> dict:
        return {"emit": self.emit, "move": self.move}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def _forget(self) -> None:
        """What is remembered of tokens, classes and pairs of classes: scores, once each."""
        self._tokens: dict[str, int] = {}       # the place of their traits
        self._traits: dict[tuple, int] = {}
        self._own: list[tuple] = []             # by traits: scores, class
        self._classes: dict[str, int] = {}
        self._names: list[str] = []
        self._beside: list[list[np.ndarray]] = [[], [], [], []]    # by class: as p, q, x, y
        self._pairs: dict[int, np.ndarray] = {}

    def _sum(self, names: list[str]) -> np.ndarray:
        return self.emit[_places(names)].sum(axis=0)

    def _class_id(self, name: str) -> int:
        if (found := self._classes.get(name)) is None:
            found = self._classes[name] = len(self._names)
            self._names.append(name)
            for of, letter in zip(self._beside, "pqxy"):
                of.append(self._sum([letter + name]))
        return found

    def _token_id(self, token: str) -> int:
        traits = _traits(token)
        if (found := self._traits.get(traits)) is None:
            found = self._traits[traits] = len(self._own)
            self._own.append((*self._sum(_own_names(traits)).tolist(), self._class_id(traits[-1])))
        if len(token) <= SHORT:
            self._tokens[token] = found
        return found

    def scores(self, tokens: list[str], whole: list[str]) -> np.ndarray:
        """(tokens, 3): the sums of the weights of ``token_features``, each
        different token, class and pair of classes looked up once."""
        if len(self._tokens) + len(self._own) > KEPT or len(self._names) > KEPT // 10 or len(self._pairs) > KEPT:
            self._forget()
        edge = [self._class_id("<"), self._class_id(">")]
        known, new = self._tokens.get, self._token_id
        ids = [i if (i := known(t)) is not None else new(t) for t in tokens]
        different, place = np.unique(np.array(ids, dtype=np.int64), return_inverse=True)
        own = np.array([self._own[i] for i in different.tolist()])[place]
        classes = np.concatenate([edge[:1] * 2, own[:, 3].astype(np.int64), edge[1:] * 2])
        out = own[:, :3] + self._sum(whole)
        different, place = np.unique(classes, return_inverse=True)
        n = len(tokens)
        for of, at in zip(self._beside, (1, 0, 3, 4)):
            out += np.array([of[c] for c in different.tolist()])[place[at:at + n]]
        pairs, place = np.unique(classes[1:n + 1] << 32 | classes[:n], return_inverse=True)
        for pair in pairs.tolist():
            if pair not in self._pairs:
                self._pairs[pair] = self._sum([f"r{self._names[pair >> 32]}|{self._names[pair & 0xFFFFFFFF]}"])
        return out + np.array([self._pairs[p] for p in pairs.tolist()])[place]

    def tags(self, tokens: list[str], whole: list[str]) -> list[tuple[int, list[int]]]:
        """The best tags of the whole sequence: (first token, tags) of the
        stretches between tokens that are outside on every best path."""
        scores = self.scores(tokens, whole)
        unsure = np.flatnonzero(~_surely_outside(scores, self.move))
        if not len(unsure):
            return []
        cut = np.flatnonzero(np.diff(unsure) > 1)
        first, last = unsure[np.concatenate([[0], cut + 1])], unsure[np.concatenate([cut, [len(unsure) - 1]])]
        return [(int(f), self.best(scores[f:t + 1])) for f, t in zip(first, last)]

    def decode(self, rows: np.ndarray) -> list[int]:
        """Best tags of tokens with these features."""
        return self.best(self.emit[rows].sum(axis=1))

    def best(self, scores: np.ndarray) -> list[int]:
        """Best tags by Viterbi; the sequence lies between outside tokens, and
        inside follows begin or inside only."""
        scores = scores.tolist()
        move = self.move.tolist()
        best, back = [move[O][t] + scores[0][t] for t in range(3)], []
        best[I] = -math.inf
        for row in scores[1:]:
            step = [max(range(3), key=lambda s: best[s] + (move[s][t] if t != I or s != O else -math.inf)) for t in range(3)]
            best = [best[s] + (move[s][t] if t != I or s != O else -math.inf) + row[t] for t, s in enumerate(step)]
            back.append(step)
        tag = max(range(3), key=lambda t: best[t] + move[t][O])
        path = [tag]
        for step in reversed(back):
            tag = step[tag]
            path.append(tag)
        return path[::-1]


def _surely_outside(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Where outside beats begin and inside whatever the tags around are.

    A path with tag k at a token is turned into one with O there; if the next
    tag is I, it becomes B, as inside cannot follow outside. Where the least gain of
    the change over all neighbours is positive, no best path has k."""
    def allowed(s: int, k: int) -> bool:
        return k != I or s != O

    sure = np.ones(len(scores), dtype=bool)
    here, after = scores, scores[1:, B] - scores[1:, I]
    for k in (B, I):
        gain = here[:, O] - here[:, k]
        enter = min(move[s][O] - move[s][k] for s in range(3) if allowed(s, k))
        leave = min(move[O][t] - move[k][t] for t in (O, B))
        sure &= gain + enter + leave > 1e-9
        # k, I, u becomes O, B, u
        turn = move[O][B] - move[k][I] + min(move[B][u] - move[I][u] for u in range(3))
        sure[:-1] &= gain[:-1] + enter + turn + after > 1e-9
    return sure


def train(feats: list[np.ndarray], tags: list[np.ndarray]) -> Field:
    """Maximum likelihood by Adam over padded segments (forward-backward)."""
    emit, move = np.zeros((DIM, 3)), np.zeros((3, 3))
    if not feats:
        emit[:, O] = 1.0
        return Field(emit, move)
    longest = 64
    cut = [(f[i:i + longest], t[i:i + longest]) for f, t in zip(feats, tags) for i in range(0, len(f), longest)]
    length = np.array([len(t) for _, t in cut])
    width = int(length.max())
    x = np.zeros((len(cut), width, WIDTH), dtype=np.int32)
    y = np.zeros((len(cut), width), dtype=np.int64)
    for i, (f, t) in enumerate(cut):
        x[i, :len(t)], y[i, :len(t)] = f, t
    mask = np.arange(width) < length[:, None]
    state = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]
    rng, t_step, batch = np.random.default_rng(11), 0, 512

    def lse(a, axis):
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    steps = max(EPOCHS, math.ceil(1500 / max(1, len(cut) // batch)) if len(cut) > batch else EPOCHS)
    for _ in range(min(steps, EPOCHS)):
        for at in np.array_split(rng.permutation(len(cut)), max(1, len(cut) // batch)):
            w = int(length[at].max())
            bx, by, bm = x[at, :w], y[at, :w], mask[at, :w]
            score = emit[bx].sum(axis=2)
            ahead = np.zeros((len(at), w, 3))
            ahead[:, 0] = move[O] + score[:, 0]
            for k in range(1, w):
                ahead[:, k] = np.where(bm[:, k, None], lse(ahead[:, k - 1, :, None] + move, 1) + score[:, k], ahead[:, k - 1])
            behind = np.zeros((len(at), w, 3))
            behind[:, w - 1] = move[:, O]
            for k in range(w - 2, -1, -1):
                nxt = lse(move + (score[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
                behind[:, k] = np.where(bm[:, k + 1, None], nxt, move[:, O])
            z = lse(ahead[:, w - 1] + move[:, O], 1)
            p = np.exp(ahead + behind - z[:, None, None]) * bm[..., None]
            grad = np.zeros_like(emit)
            gap = (np.eye(3)[by] - p) * bm[..., None]
            np.add.at(grad, bx.reshape(-1), np.repeat(gap.reshape(-1, 3), WIDTH, axis=0))
            turn = np.zeros((3, 3))
            for k in range(1, w):
                both = np.exp(ahead[:, k - 1, :, None] + move + (score[:, k] + behind[:, k])[:, None, :] - z[:, None, None])
                turn -= (both * bm[:, k, None, None]).sum(axis=0)
                np.add.at(turn, (by[:, k - 1][bm[:, k]], by[:, k][bm[:, k]]), 1.0)
            t_step += 1
            for param, g, m, v in ((emit, grad / len(at) - RIDGE * emit, *state[:2]), (move, turn / len(at) - RIDGE * move, *state[2:])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                param += RATE * (m / (1 - 0.9 ** t_step)) / (np.sqrt(v / (1 - 0.99 ** t_step)) + 1e-8) * (0.97 ** (t_step / 10))
    return Field(emit, move)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit on about ``sample`` documents chosen by a hash of their ids."""
    rows = bounded_sample(docs.where("text is not null"), "doc_id", sample).select("text").mapInPandas(
        _training, "features binary, tags binary").toArrow()
    feats = [np.frombuffer(x.as_py(), dtype="<i4").reshape(-1, WIDTH) for x in rows["features"]]
    tags = [np.frombuffer(x.as_py(), dtype=np.int8) for x in rows["tags"]]
    order = sorted(range(len(feats)), key=lambda i: (feats[i].tobytes(), tags[i].tobytes()))  # whatever the task order
    return train([feats[i] for i in order], [tags[i] for i in order])


def find_secrets(text: str | None, field: Field) -> list[tuple[int, int, int]]:
    """(start, kind, end): the base spans and those the field adds."""
    if not text:
        return []
    code, low = _points(text), _lowered(text)
    spans = [(s, k, e) for s, k, e, _ in base_spans(text, code, low)]
    starts, reach = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
    tokens = _TOKEN.findall(text)
    whole = file_features(text, code, len(segments(code, low)))
    marked = [(at + i, tags, i) for at, tags in (field.tags(tokens, whole) if tokens else ()) for i, t in enumerate(tags) if t == B]
    if marked:
        place = [m.span() for m in _TOKEN.finditer(text)]
        for at, tags, i in marked:
            j = i + 1
            while j < len(tags) and tags[j] == I:
                j += 1
            s, e = place[at][0], place[at + j - i - 1][1]
            # of the base spans that start before its end none may reach into it
            before = bisect_left(starts, e)
            if not before or reach[before - 1] <= s:
                spans.append((s, 3, e))
    return sorted(spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """Each row with n_assign, n_access, n_hex, base_sha256, spans (joined
    kind:start:end), redacted (the text with every span replaced).

    Null or empty text: no spans, the digest of the empty string; a null
    text stays null in ``redacted``. Texts of any length are read whole, in
    time proportional to it. Every row of the input, also a repeated one, gives one row
    with its other columns. Empty table: empty result.
    """
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"]

    def work(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            spans = find_secrets(text, field)
            named = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
            base = ",".join(x for x, (_, k, _) in zip(named, spans) if k < 3)
            out.append((*(sum(k == n for _, k, _ in spans) for n in range(3)),
                        hashlib.sha256(base.encode()).hexdigest(), ",".join(named), redact(text, spans)))
        return pd.DataFrame(out, columns=names)

    out = by_text(docs, work, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string", "_scan")
    return out.select(*docs.columns, *(F.col(f"_scan.{c}").alias(c) for c in names))


def redact(text: str | None, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with each span, or run of overlapping spans, replaced."""
    if not text or not spans:
        return text
    out, at = [], 0
    end = None
    for s, _, e in spans:
        if end is not None and s < end:
            end = max(end, e)
            continue
        if end is not None:
            out.append(mark)
            at = end
        out.append(text[at:s])
        at, end = s, e
    return "".join(out) + mark + text[end:]
