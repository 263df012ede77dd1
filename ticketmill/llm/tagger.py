"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Trained on texts with labelled spans, made by a seeded generator: words and lines
with personal data in plain and in loosely written forms, and with look-alikes such
as versions, dates, keys and prices that carry no label. The model is the same on
every machine and in every run.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside; then begin and inside of each kind
WINDOW = 64
CHARS = 100  # 0 pads, 1-95 printable ASCII, then white space, letters, digits, others
EMBEDDED, HIDDEN = 12, 20
EXAMPLES, EPOCHS, BATCH, RATE, SEED = 2400, 5, 48, 0.01, 7


class Weights(NamedTuple):
    embed: np.ndarray  # CHARS x EMBEDDED
    gates: np.ndarray  # 2 x (EMBEDDED + HIDDEN + 1) x 4 HIDDEN; forward and backward in time
    out: np.ndarray  # (2 HIDDEN + 1) x LABELS
    moves: np.ndarray  # LABELS x LABELS
    first: np.ndarray  # LABELS


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """Penalties: an inside label only follows the begin or inside label of its kind."""
    moves, first = np.zeros((LABELS, LABELS), np.float32), np.zeros(LABELS, np.float32)
    for inside in range(2, LABELS, 2):
        moves[:, inside] = first[inside] = -1e4
        moves[inside, inside] = moves[inside - 1, inside] = 0
    return moves, first


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = np.where((points >= 32) & (points < 127), points - 31, 99).astype(np.int64)
    odd = np.flatnonzero(codes == 99)
    for i in odd:
        c = chr(points[i])
        codes[i] = 96 if c.isspace() else 97 if c.isalpha() else 98 if c.isdigit() else 99
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(w: Weights, codes: np.ndarray) -> tuple[np.ndarray, list]:
    """Label scores (rows x time x LABELS) and what the backward pass needs."""
    rows, time = codes.shape
    both = np.stack([codes, codes[:, ::-1]])  # direction x rows x time
    x = w.embed[both]
    into = x @ w.gates[:, None, :EMBEDDED] + w.gates[:, None, None, -1]
    recur = w.gates[:, EMBEDDED:-1]
    h = np.zeros((2, rows, HIDDEN), np.float32)
    c = np.zeros_like(h)
    hs, steps = np.zeros((2, rows, time, HIDDEN), np.float32), []
    for t in range(time):
        z = into[:, :, t] + h @ recur
        s = _sigmoid(z[..., : 3 * HIDDEN])
        i, f, o = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
        g = np.tanh(z[..., 3 * HIDDEN :])
        was, before = c, h
        c = f * c + i * g
        tanh = np.tanh(c)
        h = o * tanh
        hs[:, :, t] = h
        steps.append((i, f, o, g, was, before, tanh))
    joined = np.concatenate([hs[0], hs[1][:, ::-1]], axis=2)
    return joined @ w.out[:-1] + w.out[-1], [both, x, joined, steps]


def backward(w: Weights, kept: list, d_scores: np.ndarray) -> list[np.ndarray]:
    """Gradients of embed, gates and out."""
    both, x, joined, steps = kept
    rows, time, _ = d_scores.shape
    d_out = np.concatenate([np.einsum("rth,rtl->hl", joined, d_scores), d_scores.sum((0, 1))[None]])
    d_joined = d_scores @ w.out[:-1].T
    d_hs = np.stack([d_joined[..., :HIDDEN], d_joined[:, ::-1, HIDDEN:]])
    recur, enter = w.gates[:, EMBEDDED:-1], w.gates[:, :EMBEDDED]
    d_gates, d_embed = np.zeros_like(w.gates), np.zeros_like(w.embed)
    d_h = np.zeros((2, rows, HIDDEN), np.float32)
    d_c = np.zeros_like(d_h)
    for t in range(time - 1, -1, -1):
        i, f, o, g, was, before, tanh = steps[t]
        d_h = d_h + d_hs[:, :, t]
        d_c = d_c + d_h * o * (1 - tanh**2)
        d_z = np.concatenate(
            [d_c * g * i * (1 - i), d_c * was * f * (1 - f), d_h * tanh * o * (1 - o), d_c * i * (1 - g**2)], axis=2
        )
        d_gates[:, :EMBEDDED] += x[:, :, t].transpose(0, 2, 1) @ d_z
        d_gates[:, EMBEDDED:-1] += before.transpose(0, 2, 1) @ d_z
        d_gates[:, -1] += d_z.sum(1)
        np.add.at(d_embed, both[:, :, t].ravel(), (d_z @ enter.transpose(0, 2, 1)).reshape(-1, EMBEDDED))
        d_h, d_c = d_z @ recur.transpose(0, 2, 1), d_c * f
    return [d_embed, d_gates, d_out]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def crf_gradient(scores: np.ndarray, labels: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[float, list]:
    """Mean negative log likelihood, and gradients of scores, moves and first."""
    rows, time, size = scores.shape
    ahead = np.zeros_like(scores)
    ahead[:, 0] = first + scores[:, 0]
    for t in range(1, time):
        ahead[:, t] = scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + moves, 1)
    total = _log_sum(ahead[:, -1], 1)
    back = np.zeros_like(scores)
    d_moves = np.zeros_like(moves)
    for t in range(time - 2, -1, -1):
        step = moves + (scores[:, t + 1] + back[:, t + 1])[:, None]
        back[:, t] = _log_sum(step, 2)
        d_moves += np.exp(ahead[:, t, :, None] + step - total[:, None, None]).sum(0)
    d_scores = np.exp(ahead + back - total[:, None, None])
    d_first = d_scores[:, 0].sum(0)
    row = np.arange(rows)
    gold = first[labels[:, 0]] + scores[row[:, None], np.arange(time), labels].sum(1) + moves[labels[:, :-1], labels[:, 1:]].sum(1)
    d_scores[row[:, None], np.arange(time), labels] -= 1
    np.add.at(d_moves, (labels[:, :-1], labels[:, 1:]), -1)
    np.add.at(d_first, labels[:, 0], -1)
    return float((total - gold).mean()), [d_scores / rows, d_moves / rows, d_first / rows]


def decode(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """The best label sequence of each row; with ``lengths``, which must fall, it ends there and is 0 beyond."""
    rows, time, _ = scores.shape
    lengths = np.full(rows, time) if lengths is None else lengths
    open_ = rows - np.searchsorted(lengths[::-1], np.arange(time), side="right")  # rows that reach a time
    best, came = first + scores[:, 0], np.zeros(scores.shape, np.int8)
    for t in range(1, time):
        k = open_[t]
        step = best[:k, :, None] + moves
        came[:k, t] = step.argmax(1)
        best[:k] = step.max(1) + scores[:k, t]
    found = np.zeros((rows, time), np.int64)
    found[np.arange(rows), lengths - 1] = best.argmax(1)
    for t in range(time - 1, 0, -1):
        k = open_[t]
        found[:k, t - 1] = came[np.arange(k), t, found[:k, t]]
    return found


def window_scores(w: Weights, codes: np.ndarray, batch: int = 512) -> np.ndarray:
    """Label scores of windows of character codes."""
    found = np.zeros((*codes.shape, LABELS), np.float32)
    for at in range(0, len(codes), batch):
        found[at : at + batch] = forward(w, codes[at : at + batch])[0]
    return found


def best_labels(w: Weights, runs: list[np.ndarray]) -> list[np.ndarray]:
    """Labels of runs of any lengths from their label scores; runs of about one length are decoded together."""
    moves, first = allowed()
    alike: dict[int, list[int]] = {}
    for i in sorted(range(len(runs)), key=lambda i: -len(runs[i])):
        alike.setdefault(len(runs[i]).bit_length(), []).append(i)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
    for some in alike.values():
        lengths = np.array([len(runs[i]) for i in some])
        scores = np.zeros((len(some), lengths[0], LABELS), np.float32)
        for row, i in enumerate(some):
            scores[row, : lengths[row]] = runs[i]
        for i, labels, n in zip(some, decode(scores, w.moves + moves, w.first + first, lengths), lengths, strict=True):
            found[i] = labels[:n]
    return found


# --- training -----------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _word(r: random.Random) -> str:
    word = "".join(r.choice("bcdfghjklmnprstvwzéüñ") * r.randint(0, 1) + r.choice("aeiouáöy") for _ in range(r.randint(1, 4)))
    return word.capitalize() if r.random() < 0.1 else word


def _plain(r: random.Random) -> str:
    """Look-alikes and fillers that are no personal data."""
    kind = r.randrange(12)
    hex_ = "".join(r.choice("0123456789abcdef") for _ in range(r.choice((18, 32, 40))))
    return (
        f"{r.randint(0, 9)}.{r.randint(0, 20)}" + ("." if r.random() < 0.5 else f".{r.randint(0, 9)}."),
        f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
        f"{r.randint(0, 23)}:{r.randint(10, 59)}",
        f"password={hex_}",
        f'token = "{hex_}"',
        "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
        f"${r.randint(1, 9999)}.{_digits(r, 2)}",
        f"#{r.randint(1, 99999)}",
        f"@{_word(r)}",
        f"version {r.randint(1, 9)}.",
        "".join(r.choice("!%*&$|#") for _ in range(r.randint(2, 9))),
        f"{r.randint(1, 400)}",
    )[kind]


def _personal(r: random.Random) -> tuple[str, str]:
    """A kind and a text of that kind, some of them loosely written."""
    kind, loose = r.choice(KINDS), r.random() < 0.3
    if kind == "email":
        user = _word(r) + r.choice((".", "_", "-", "", "+")) + r.choice((_word(r), _digits(r, 2), ""))
        user = user.strip("._-+").encode("ascii", "ignore").decode() or "info"
        host = r.choice(("mail", "example", "corp", "uni", "web")) + r.choice(("", str(r.randint(1, 9))))
        end = r.choice(("com", "example.com", "org", "net", "co.uk", "de"))
        return kind, f"{user}{r.choice((' @ ', '@ ', ' @'))}{host}.{end}" if loose else f"{user}@{host}.{end}"
    if kind == "ip":
        return kind, (" . " if loose else ".").join(str(r.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = r.choice(("4", "5", "37")) + _digits(r, r.choice((14, 14, 13)))
        body += next(d for d in "0123456789" if luhn(body + d))
        between = r.choice((".", "/", "_")) if loose else r.choice(("", "", " ", "-"))
        return kind, between.join(body[i : i + 4] for i in range(0, len(body), 4))
    country = f"{r.choice(('00', '')) if loose else '+'}{r.randint(1, 99)}"
    if loose and country[:2] != "00":
        return kind, f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}"
    area = f"({_digits(r, 3)})" if r.random() < 0.5 else _digits(r, 3)
    return kind, f"{country} {area}{r.choice((' ', '-', '.'))}{_digits(r, 3)}{r.choice((' ', '-', '.'))}{_digits(r, 4)}"


def examples(count: int = EXAMPLES, seed: int = SEED) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Texts of WINDOW characters and more, with their labelled spans."""
    r = random.Random(seed)
    for _ in range(count):
        text, spans = "", []
        while len(text) < WINDOW + 20:
            draw = r.random()
            if draw < 0.16:
                kind, part = _personal(r)
                spans.append((kind, len(text), len(text) + len(part)))
                text += part
            else:
                text += _plain(r) if draw < 0.3 else _word(r)
            text += r.choice((" ", " ", " ", " ", ", ", ". ", "\n", ".\n", "; ", " | "))
        yield text, spans


def _windows(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = random.Random(seed + 1)
    codes, labels = np.zeros((count, WINDOW), np.int64), np.zeros((count, WINDOW), np.int64)
    for row, (text, spans) in enumerate(examples(count, seed)):
        marks = np.zeros(len(text), np.int64)
        for kind, start, end in spans:
            marks[start:end] = 2 + 2 * KINDS.index(kind)
            marks[start] -= 1
        at = r.randint(0, 20)
        kept = r.randint(WINDOW // 2, WINDOW) if r.random() < 0.2 else WINDOW
        codes[row, :kept] = char_codes(text)[at : at + kept]
        labels[row, :kept] = marks[at : at + kept]
        if labels[row, 0] and labels[row, 0] % 2 == 0:  # a span cut off at the left begins here
            labels[row, 0] -= 1
    return codes, labels


@lru_cache(2)
def trained(count: int = EXAMPLES, epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """Weights after training with Adam; about ten seconds."""
    rng = np.random.default_rng(seed)
    scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    w = Weights(
        scale(CHARS, EMBEDDED) * np.float32(3),
        scale(2, EMBEDDED + HIDDEN + 1, 4 * HIDDEN),
        scale(2 * HIDDEN + 1, LABELS),
        np.zeros((LABELS, LABELS), np.float32),
        np.zeros(LABELS, np.float32),
    )
    codes, labels = _windows(count, seed)
    penalty, first = allowed()
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    steps = epochs * -(-count // BATCH)
    for _ in range(epochs):
        order = rng.permutation(count)
        for at in range(0, count, BATCH):
            some = order[at : at + BATCH]
            scores, kept = forward(w, codes[some])
            _, (d_scores, d_moves, d_first) = crf_gradient(scores, labels[some], w.moves + penalty, w.first + first)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for p, g, m, v in zip(w, [*backward(w, kept, d_scores.astype(np.float32)), d_moves, d_first], mean, square, strict=True):
                g = np.clip(g, -5, 5)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w
