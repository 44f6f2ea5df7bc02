"""Personal data: fixed patterns, and a character network that finds what they miss.

The network reads characters in both directions with long short-term memory and scores a tag per
character (outside, or beginning and inside of each kind); a conditional random field adds
transitions, and Viterbi decoding picks the best allowed sequence.  It is trained in numpy on the
labelled spans of a bounded sample of texts.  The patterns label the sample; so that the network learns
what they cannot say, each text also comes with its spans written in other ways (``varied``: other
separators, brackets, no plus, spaces around the ``@``, letters beyond ASCII), with such spans planted
between its words, and with numbers that are none (dates, amounts, ranges).  Windows with runs that could be either
are left out of the loss.

A text is read in windows that overlap by half.  Every character takes its tag from the window in
which it is most central, and spans are read off the joined tags of the whole text, so a span that
crosses windows comes out once.  A found span is set to whole tokens, and counts if it does not overlap a
span of the patterns, could be its kind, and its tags are sure.

Every kind needs a digit, an ``@`` or a bracketed "at" in a span, so windows without one cannot change
the result and are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import class_sample, pieces_of, small_batches, sums_by, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, number of the kind, end

WINDOW, STRIDE = 96, 48
HIDDEN, WIDTH, SYMBOLS = 16, 10, 100
TAGS = 1 + 2 * len(KINDS)  # outside, then beginning and inside of each kind
SAMPLE_TEXTS = 1500  # texts with a trigger that are learned from
SAMPLE_WORDS = 600_000  # words of all of them; fewer texts are drawn if theirs are more
STEPS, BATCH, RATE, SEED = 360, 96, 0.03, 3
SURE = 0.6  # least mean probability of the tags of a span, given the whole window

TRIGGER = re.compile(r"[0-9@]|(?<=[\[(])at(?=[\])])")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and without overlaps per kind, sorted."""
    if not TRIGGER.search(text):
        return []
    out: list[Span] = []
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, 0, m.end()))
            end = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


_AT = re.compile(r"\s?[\[(]at[\])]\s?|\s?@\s?")
_DOT = re.compile(r"\s?[\[(]dot[\])]\s?")


def plausible(kind: int, span: str) -> bool:
    """Whether a span of the network could be of its kind, however it is written."""
    if span != span.strip():
        return False
    n = len(_digits(span))
    if kind == 0:
        name, at, host = _AT.sub("@", _DOT.sub(".", span)).partition("@")
        labels = host.split(".")
        return bool(at and name and len(labels) > 1 and all(labels)) and "@" not in host and not re.search(r"[\s()\[\],;]", name + host)
    if kind == 1:
        parts = re.split(r"[^0-9]+", span)
        between = set(re.findall(r"[^0-9]+", span))
        return len(parts) == 4 and len(between) == 1 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= n <= 19 and luhn(_digits(span)) and not re.search("[A-Za-z@]", span)
    return 10 <= n <= 15 and not re.search("[A-Za-z@]", span) and not span.isdigit()


# ---- spans written in other ways, for training -----------------------------------------------------


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _name(rng: random.Random, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))


def varied(kind: int, rng: random.Random, digits: str = "") -> str:
    """A span of a kind in a form that the patterns miss, with the given digits if they fit."""
    if kind == 0:
        name = rng.choice(["", _name(rng) + rng.choice(["", ".", "_"])]) + _name(rng) + rng.choice(["", _number(rng, 2)])
        host = [_name(rng) + rng.choice(["", "-" + _name(rng), _number(rng, 1)]) for _ in range(rng.choice([1, 1, 2]))] + [rng.choice(["com", "org", "net", "de", "example"])]
        form = rng.randrange(6)
        if form == 0:
            return f"{name}{rng.choice('éñüßøç')}@{'.'.join(host)}"
        if form == 1:
            return f"{name}@{_name(rng)}{rng.choice('éñüøç')}{_name(rng)}.{'.'.join(host[1:])}"
        at = rng.choice([" @ ", " @ ", " @", "@ "]) if form < 4 else rng.choice(["[at]", "(at)", " [at] ", " (at) "])
        dot = rng.choice([".", "[dot]", " (dot) "]) if form == 5 else "."
        return f"{name}{at}{dot.join(host)}"
    if kind == 1:
        return rng.choice(["-", "-", ":", " . ", "[.]", "_", " "]).join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        if len(digits) != 16:
            body = _number(rng, 15)
            digits = next(body + d for d in "0123456789" if luhn(body + d))
        parts = [digits[i : i + 4] for i in range(0, 16, 4)]
        return rng.choice([".", ".", "/", "  ", " - ", "_", "."]).join(parts)
    d = digits[-10:] if len(digits) >= 10 else _number(rng, 10)
    forms = [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"({d[:3]}){d[3:6]} {d[6:]}", f"0{d[:3]} {d[3:6]} {d[6:]}",
             f"00{d[:2]} {d[2:5]} {d[5:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"{d[:3]}/{d[3:6]}-{d[6:]}"]
    return rng.choice(forms)


def harmless(rng: random.Random) -> str:
    """A number that is no personal data."""
    y, m, d = rng.randrange(1900, 2040), rng.randrange(1, 13), rng.randrange(1, 29)
    return rng.choice([
        f"{y}-{m:02}-{d:02}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{d:02}:{m:02}:{rng.randrange(60):02}", f"{y}-{m:02}-{d:02} {m:02}:{d:02}:00",
        f"{y}-{y + 3}", f"1,{_number(rng, 3)},{_number(rng, 3)}.{_number(rng, 2)}", f"{_number(rng, 3)} {_number(rng, 3)}", f"{m}.{d}.{m}", f"#{_number(rng, 8)}",
        _number(rng, rng.randrange(5, 18)), f"978-{m}-{_number(rng, 4)}-{_number(rng, 4)}-{m % 10}", f"{_number(rng, 2)}.{_number(rng, 4)}, {_number(rng, 2)}.{_number(rng, 4)}",
        f"@{_name(rng)}", f"{m} @ {d}", f"{m}-{d}-{y}-{_number(rng, 4)}",
    ])


def rewritten(text: str, spans: list[Span], rng: random.Random) -> tuple[str, list[Span]]:
    """A text with its spans in other forms, and with some more spans and harmless numbers between words."""
    parts, at, out, size = [], 0, [], 0

    def put(piece: str, kind: int | None = None) -> None:
        nonlocal size
        if kind is not None:
            out.append((size, kind, size + len(piece)))
        parts.append(piece)
        size += len(piece)

    gaps = [m.start() for m in re.finditer(r"(?<=\w) (?=\w)", text)]
    gaps = [g for g in gaps if not any(s <= g < e for s, _, e in spans)]
    chosen = rng.sample(gaps, min(len(gaps), 3 + len(gaps) // 60))
    events = sorted([(s, e, k) for s, k, e in spans] + [(g, g + 1, None) for g in chosen], key=lambda x: (x[0], x[1]))
    for start, end, kind in events:
        if start < at:
            continue
        put(text[at:start])
        if kind is not None:
            put(varied(kind, rng, _digits(text[start:end])), kind)
        else:
            put(" ")
            some = rng.randrange(8)
            if some < len(KINDS):
                put(varied(some, rng), some)
            else:
                put(harmless(rng))
            put(" ")
        at = end
    put(text[at:])
    return "".join(parts), out


_DOUBTFUL = re.compile(r"@|[+(]?[0-9](?:[\x20().+:/_\[\]-]{0,3}[0-9]){9,}")


def doubtful(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Runs outside labelled spans that could be personal data in another form."""
    out = []
    for m in _DOUBTFUL.finditer(text):
        labelled = any(s < m.end() and m.start() < e for s, _, e in spans)
        if not labelled and (m[0] == "@" or plausible(2, m[0]) or plausible(3, m[0])):
            out.append((m.start(), m.end()))
    return out


def _symbols() -> np.ndarray:
    """Symbol of each code point below 256; all digits share one, other letters share one."""
    table = np.full(256, 2, np.int64)
    for c in range(33, 127):
        table[c] = 4 + c - 33
    for c in b" \t\n\r\x0b\x0c\xa0":
        table[c] = 1
    for c in range(48, 58):
        table[c] = 3
    return table


_SYMBOL = _symbols()


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 256, _SYMBOL[np.minimum(points, 255)], 2)


def allowed() -> np.ndarray:
    """Penalty of tag transitions: an inside tag follows only its own kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -1e4
        out[1 + 2 * k, 2 + 2 * k] = out[2 + 2 * k, 2 + 2 * k] = 0
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    parameters: dict[str, np.ndarray]

    @classmethod
    def new(cls) -> Tagger:
        rng = np.random.default_rng(SEED)
        p = {"embed": rng.standard_normal((SYMBOLS, WIDTH)) * 0.3, "out": rng.standard_normal((2 * HIDDEN, TAGS)) * 0.2, "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS))}
        for d in "fb":
            p |= {f"x{d}": rng.standard_normal((WIDTH, 4 * HIDDEN)) * 0.3, f"h{d}": rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.3, f"c{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
        return cls(p)

    def emissions(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Tag scores of windows of symbols, (windows, characters, tags); ``keep`` gets the inner states."""
        p, (n, steps) = self.parameters, x.shape
        states = np.zeros((steps, n, 2 * HIDDEN))
        for d in "fb":
            rows, u = p["embed"] @ p[f"x{d}"] + p[f"c{d}"], p[f"h{d}"]
            h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            side = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                z = rows[x[:, t]] + h @ u
                ifo = sigmoid(z[:, : 3 * HIDDEN])
                i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
                g = np.tanh(z[:, 3 * HIDDEN :])
                m = mask[:, t, None]
                new_c = (f * c + i * g) * m
                tanh_c = np.tanh(new_c)
                if keep is not None:
                    keep[d, t] = (h, c, i, f, o, g, tanh_c)
                h, c = o * tanh_c * m, new_c
                states[t, :, side] = h
        if keep is not None:
            keep["states"] = states
        return (states @ p["out"] + p["bias"]).transpose(1, 0, 2)

    def decode(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best allowed tags of windows, and the probability of each tag by itself."""
        e = self.emissions(x, mask)
        move, n, steps = self.parameters["move"] + allowed(), *x.shape
        start = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0.0)
        start[0] = 0
        score, back = e[:, 0] + start, np.zeros((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            paths = score[:, :, None] + move
            best = paths.argmax(axis=1)
            on = mask[:, t] > 0
            back[t] = np.where(on[:, None], best, np.arange(TAGS))
            score = np.where(on[:, None], np.take_along_axis(paths, best[:, None], 1)[:, 0] + e[:, t], score)
        tags = np.zeros((n, steps), np.int64)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        tags = np.where(mask > 0, tags, 0)
        sure = np.ones((n, steps))
        some = np.flatnonzero(tags.any(axis=1))
        if len(some):
            single = self.marginals(e[some], mask[some] > 0)
            sure[some] = np.take_along_axis(single, tags[some][:, :, None], 2)[:, :, 0]
        return tags, sure

    def marginals(self, e: np.ndarray, on: np.ndarray) -> np.ndarray:
        """Probability of every tag at every character, over all sequences; steps are scaled to sum to one."""
        n, steps, _ = e.shape
        move = np.exp(self.parameters["move"] + allowed())
        score = np.exp(e - e.max(axis=2, keepdims=True))
        ahead, behind = np.zeros((steps, n, TAGS)), np.ones((steps, n, TAGS))
        ahead[0] = score[:, 0] * np.where((np.arange(TAGS) % 2 == 1) | (np.arange(TAGS) == 0), 1.0, 0.0)
        ahead[0] /= ahead[0].sum(axis=1, keepdims=True)
        for t in range(1, steps):
            here = (ahead[t - 1] @ move) * score[:, t]
            ahead[t] = np.where(on[:, t, None], here / np.maximum(here.sum(axis=1, keepdims=True), 1e-300), ahead[t - 1])
        for t in range(steps - 2, -1, -1):
            here = (score[:, t + 1] * behind[t + 1]) @ move.T
            behind[t] = np.where(on[:, t + 1, None], here / np.maximum(here.sum(axis=1, keepdims=True), 1e-300), behind[t + 1])
        single = (ahead * behind).transpose(1, 0, 2)
        return single / np.maximum(single.sum(axis=2, keepdims=True), 1e-300)

    def gradients(self, x: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of windows' tags, and its gradients."""
        p, (n, steps) = self.parameters, x.shape
        kept: dict = {}
        e = self.emissions(x, mask, kept)
        move = p["move"] + allowed()
        start = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0.0)
        start[0] = 0
        on = mask > 0
        ahead, behind = np.zeros((steps, n, TAGS)), np.zeros((steps, n, TAGS))
        ahead[0] = e[:, 0] + start
        for t in range(1, steps):
            ahead[t] = np.where(on[:, t, None], _logsum(ahead[t - 1][:, :, None] + move, 1) + e[:, t], ahead[t - 1])
        for t in range(steps - 2, -1, -1):
            behind[t] = np.where(on[:, t + 1, None], _logsum(move[None] + (e[:, t + 1] + behind[t + 1])[:, None, :], 2), behind[t + 1])
        total = _logsum(ahead[-1], 1)
        truth = np.eye(TAGS)[tags] * on[:, :, None]
        gold = (truth * e).sum(axis=(1, 2)) + start[tags[:, 0]] + (move[tags[:, :-1], tags[:, 1:]] * on[:, 1:]).sum(axis=1)
        single = np.exp((ahead + behind).transpose(1, 0, 2) - total[:, None, None]) * on[:, :, None]
        d_e = (single - truth) / n
        d_move = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            pair = np.exp(ahead[t - 1][:, :, None] + move + (e[:, t] + behind[t])[:, None, :] - total[:, None, None])
            d_move += (pair * on[:, t, None, None]).sum(axis=0) / n
        np.add.at(d_move, (tags[:, :-1], tags[:, 1:]), -mask[:, 1:] / n)
        g = {"move": d_move, "out": np.einsum("tnh,ntk->hk", kept["states"], d_e), "bias": d_e.sum(axis=(0, 1)), "embed": np.zeros_like(p["embed"])}
        back = d_e.transpose(1, 0, 2) @ p["out"].T
        for d in "fb":
            u, side = p[f"h{d}"], slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            dh, dc, du = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros_like(u)
            inner = np.empty((steps, n, 4 * HIDDEN))
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, c, i, f, o, gg, tanh_c = kept[d, t]
                m = mask[:, t, None]
                dh = (dh + back[t, :, side]) * m
                dc = (dc + dh * o * (1 - tanh_c**2)) * m
                dz = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - gg**2)], axis=1)
                inner[t] = dz
                du += h.T @ dz
                dh, dc = dz @ u.T, dc * f
            symbols = x.T.ravel()
            order = np.argsort(symbols, kind="stable")
            rows = sums_by(symbols[order], inner.reshape(n * steps, -1)[order], SYMBOLS)
            g |= {f"h{d}": du, f"x{d}": p["embed"].T @ rows, f"c{d}": rows.sum(axis=0)}
            g["embed"] += rows @ p[f"x{d}"].T
        return float((total - gold).mean()), g


def windows(points: np.ndarray, triggers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of a text's symbols that hold a trigger: symbols, mask, start."""
    n = len(points)
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    if triggers is not None:
        # A window matters if a trigger lies in it or close enough to share a span with it.
        near = np.searchsorted(triggers, starts - STRIDE) < np.searchsorted(triggers, starts + WINDOW + STRIDE)
        starts = starts[near]
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < n
    return np.where(inside, np.append(points, 0)[np.minimum(at, n)], 0), inside.astype(np.float64), starts


def tags_of(spans: list[Span], n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for start, kind, end in spans:
        if not out[start:end].any():
            out[start:end] = 2 + 2 * kind
            out[start] = 1 + 2 * kind
    return out


def train(texts: list[str], labelled: list[list[Span]]) -> Tagger:
    """Fit on windows around the triggers of texts with labelled spans, and of the same texts rewritten."""
    tagger = Tagger.new()
    xs, ms, ts = [], [], []
    variation = random.Random(SEED)
    for text, spans in zip(texts, labelled, strict=True):
        skipped = doubtful(text, spans)
        for own, marked, left_out in ((text, spans, skipped), (*rewritten(text, spans, variation), [])):
            triggers = np.array([m.start() for m in TRIGGER.finditer(own)], np.int64)
            if not len(triggers) or (own is not text and skipped):
                continue
            x, mask, starts = windows(codes(own), triggers)
            tags = np.append(tags_of(marked, len(own)), np.zeros(WINDOW, np.int64))
            for row, on, start in zip(x, mask, starts, strict=True):
                if any(s < start + WINDOW and start < e for s, e in left_out):
                    continue
                cut = tags[start : start + WINDOW].copy()
                if cut[0] and cut[0] % 2 == 0:
                    cut[0] -= 1  # a span that began before the window begins with it
                xs.append(row)
                ms.append(on)
                ts.append(cut)
    if not xs:
        return tagger
    x, mask, tags = np.array(xs), np.array(ms), np.array(ts)
    rng = np.random.default_rng(SEED)
    # Windows with a span are drawn as often as windows without one.
    has = tags.any(axis=1)
    chance = np.where(has, 0.5 / max(1, has.sum()), 0.5 / max(1, (~has).sum()))
    chance /= chance.sum()
    m = {k: np.zeros_like(v) for k, v in tagger.parameters.items()}
    v = {k: np.zeros_like(w) for k, w in tagger.parameters.items()}
    for step in range(1, STEPS + 1):
        part = rng.choice(len(x), BATCH, p=chance)
        _, g = tagger.gradients(x[part], mask[part], tags[part])
        size = np.sqrt(sum((w**2).sum() for w in g.values()))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, w in g.items():
            w = w / max(1.0, size)
            m[k], v[k] = 0.9 * m[k] + 0.1 * w, 0.99 * v[k] + 0.01 * w * w
            tagger.parameters[k] = tagger.parameters[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def reconciled(n: int, starts: np.ndarray, tags: np.ndarray, sure: np.ndarray) -> list[tuple[Span, float]]:
    """Spans of a text of n characters from the tags of its windows, with their mean probability.

    Windows are in order.  A character belongs to the window whose middle is nearest.
    """
    joined, trust = np.zeros(n, np.int64), np.zeros(n)
    for k, start in enumerate(starts):
        lo = start if k == 0 or starts[k - 1] + STRIDE != start else start + (WINDOW - STRIDE) // 2
        hi = start + WINDOW if k + 1 == len(starts) or start + STRIDE != starts[k + 1] else start + (WINDOW + STRIDE) // 2
        lo, hi = max(lo, 0), min(hi, n)
        joined[lo:hi], trust[lo:hi] = tags[k, lo - start : hi - start], sure[k, lo - start : hi - start]
    out, i = [], 0
    marked = np.flatnonzero(joined)
    while len(marked):
        i = int(marked[0])
        kind, j = (joined[i] - 1) // 2, i + 1
        while j < n and joined[j] == 2 + 2 * kind:
            j += 1
        out.append(((i, int(kind), j), float(trust[i:j].mean())))
        marked = marked[np.searchsorted(marked, j) :]
    return out


def whole_tokens(text: str, span: Span) -> Span:
    """A span that cuts no number or word and neither starts nor ends with a separator."""
    start, kind, end = span
    if kind == 0:
        edge = re.compile(r"[\s,;:<>\"'!?]")
        while start > 0 and not edge.match(text[start - 1]) and text[start - 1] not in "([":
            start -= 1
        while end < len(text) and not edge.match(text[end]):
            end += 1
        while end > start and (text[end - 1] in ".)]" or edge.match(text[end - 1])):
            end -= 1
        while start < end and (text[start] in ".([" or edge.match(text[start])):
            start += 1
        return start, kind, end
    while start > 0 and text[start - 1] in "0123456789":
        start -= 1
    while end < len(text) and text[end] in "0123456789":
        end += 1
    first = "0123456789+(" if kind == 3 else "0123456789"
    while start < end and text[start] not in first:
        start += 1
    while end > start and text[end - 1] not in "0123456789":
        end -= 1
    if kind == 3 and start > 0 and text[start - 1] == "(" and ")" in text[start:end]:
        start -= 1
    return start, kind, end


def find(texts: list[str], tagger: Tagger, chunk: int = 2048) -> list[tuple[list[Span], list[Span]]]:
    """Per text: the patterns' spans, and all spans."""
    out, jobs = [], []
    for k, text in enumerate(texts):
        base = pattern_spans(text)
        out.append((base, list(base)))
        triggers = np.array([m.start() for m in TRIGGER.finditer(text)], np.int64)
        if len(triggers):
            jobs.append((k, *windows(codes(text), triggers)))
    if not jobs:
        return out
    x, mask = np.concatenate([j[1] for j in jobs]), np.concatenate([j[2] for j in jobs])
    decoded = [tagger.decode(x[i : i + chunk], mask[i : i + chunk]) for i in range(0, len(x), chunk)]
    tags, sure = (np.concatenate([d[i] for d in decoded]) for i in (0, 1))
    first = 0
    for k, _, _, starts in jobs:
        last = first + len(starts)
        base, every = out[k]
        for span, trust in reconciled(len(texts[k]), starts, tags[first:last], sure[first:last]):
            if trust < SURE:
                continue
            start, kind, end = whole_tokens(texts[k], span)
            free = not any(s < end and start < e for s, _, e in every)
            if free and plausible(kind, texts[k][start:end]):
                every.append((start, kind, end))
        every.sort()
        first = last
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def fit(docs: DataFrame, sample: int = SAMPLE_TEXTS) -> Tagger:
    """Train on a bounded sample of whole texts with a trigger; the patterns label it."""
    own = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike(TRIGGER.pattern))
    rows = class_sample(own.withColumn("all", F.lit(0)), "all", "text", sample, SAMPLE_WORDS, "pii")
    texts = sorted(r["text"] for r in rows)
    return train(texts, [pattern_spans(t) for t in texts])


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def detect(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Personal data per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and ``base_sha256`` cover the fixed patterns; ``spans`` adds what the network finds.
    Offsets are code points.  Null and empty texts have no spans; texts are read whole; repeated rows
    and equal or null ids are kept apart; other columns are ignored; an empty table gives no rows.
    """
    tagger = tagger or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 << 20):
            found = find(texts_of(batch, "text"), shared.value)
            counts = [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(len(KINDS))]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([written(every) for _, every in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return _texts(docs).mapInArrow(scan, schema)


def redacted_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans are replaced together."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with personal data in ``text`` replaced by ``<KIND>``.

    ``n_chars``, if there is such a column, follows the new text; null texts stay null.
    """
    small_batches(docs.sparkSession)
    tagger = tagger or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    names = docs.columns

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            found = find([t or "" for t in texts], shared.value)
            new = [None if t is None else redacted_text(t, every) for t, (_, every) in zip(texts, found, strict=True)]
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(new, batch.column("text").type)
            if "n_chars" in columns:
                old = columns["n_chars"]
                sizes = [o if a == b else len(b) for o, a, b in zip(old.to_pylist(), texts, new, strict=True)]
                columns["n_chars"] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return docs.mapInArrow(replace, docs.schema)
