"""Step functions of the sequence operators, shared by batch and streaming.

A fold reads the rows of one key in order. `segment` takes the input columns of
some consecutive rows and the state before them, and returns the output columns
and the state after them. A chart is what the rows do to any state before them:
`extend` grows it by some rows, `through` takes a state through it. Charts are small
lists of numbers, so the parts of a key that lie in different tasks are linked by
one pass over their charts.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np

State = tuple


class Fold:
    inputs: tuple[str, ...]
    outputs: tuple[tuple[str, str], ...]

    def resume(self, end: State) -> State:
        """The state the next rows start from."""
        return end

    def chart(self) -> list:
        """The chart of no rows."""
        raise NotImplementedError

    def extend(self, chart: list, columns: list[list]) -> list:
        raise NotImplementedError

    def through(self, chart: list, start: State) -> State:
        raise NotImplementedError


class _Shifted(Fold):
    """A fold whose end is known for any start from that for the first state and the number of rows."""

    def chart(self) -> list:
        return [0, *self.first()]

    def extend(self, chart: list, columns: list[list]) -> list:
        _, end = self.segment(columns, tuple(chart[1:]))
        return [chart[0] + len(columns[0]), *end]


@dataclass(frozen=True)
class Ema(_Shifted):
    """e <- alpha * x + (1 - alpha) * e, starting at 0."""

    alpha: float
    inputs = ("x",)
    outputs = (("ema", "double"),)

    def __post_init__(self) -> None:
        if not 0.0 < self.alpha <= 1.0:
            raise ValueError("alpha must be in (0, 1]")

    def first(self) -> State:
        return (0.0,)

    def segment(self, columns: list[list], state: State) -> tuple[list[list], State]:
        """Closed form over runs short enough that the weights stay in range."""
        x = np.asarray(columns[0], dtype=float)
        keep = 1.0 - self.alpha
        if keep == 0.0:
            return [x.tolist()], (float(x[-1]),)
        run = int(min(4096, max(1, 600 / -math.log(keep))))
        out, e = [], state[0]
        for at in range(0, len(x), run):
            part = x[at : at + run]
            weights = keep ** np.arange(1, len(part) + 1)
            values = weights * (e + np.cumsum(self.alpha * part / weights))
            out.append(values)
            e = float(values[-1])
        return [np.concatenate(out).tolist()], (e,)

    def through(self, chart: list, start: State) -> State:
        rows, end = chart
        return (end + (1.0 - self.alpha) ** rows * start[0],)


@dataclass(frozen=True)
class ResettingEma(Fold):
    """The average with thresholds; reaching ``stop`` raises an alert and resets it to 0.

    The end as a function of the start is in pieces: below a bound the rows reset nothing, and
    the end is a line; from there on a start in [low, next low) is reset at some row, and all
    that follows is one number. Rows move that number, lower the bound, and join pieces that
    are reset by the same row. A line gets flat (a start counts for less than one part in
    10^18) after about 40 / alpha rows, so a chart has no more pieces than that, however many
    rows it stands for. A start within rounding of a bound may be taken for its neighbour.
    """

    alpha: float
    warn: float
    stop: float
    inputs = ("x",)
    outputs = (("ema", "double"), ("alert", "string"))

    def first(self) -> State:
        return (0.0,)

    def segment(self, columns: list[list], state: State) -> tuple[list[list], State]:
        e = state[0]
        averages, alerts = [], []
        for x in columns[0]:
            e = self.alpha * x + (1.0 - self.alpha) * e
            averages.append(e)
            if e >= self.stop:
                alerts.append("stop")
                e = 0.0
            else:
                alerts.append("warn" if e >= self.warn else None)
        return [averages, alerts], (e,)

    def chart(self) -> list:
        """[bound, factor and offset of the line, lows of the pieces, each piece's number, the numbers]."""
        return [self.stop, 1.0, 0.0, [], [], []]

    def extend(self, chart: list, columns: list[list]) -> list:
        bound, factor, offset, lows, owns, ends = chart
        lows, owns, ends = list(lows), list(owns), list(ends)
        keep = 1.0 - self.alpha
        for x in columns[0]:
            add = self.alpha * x
            reset = None
            for i, e in enumerate(ends):
                e = add + keep * e
                if e >= self.stop:
                    e, reset = 0.0, i if reset is None else reset
                ends[i] = e
            if bound > 0.0:
                factor, offset = factor * keep, add + keep * offset
                if factor * bound + offset >= self.stop:
                    low = max((self.stop - offset) / factor, 0.0) if factor > 0.0 else 0.0
                    if low < bound:
                        bound = low
                        lows.insert(0, low)
                        if reset is None:
                            reset = len(ends)
                            ends.append(0.0)
                        owns.insert(0, reset)
                if bound > 0.0 and factor < 1e-18:
                    lows.insert(0, 0.0)
                    owns.insert(0, len(ends))
                    ends.append(offset)
                    bound = 0.0
            if reset is not None and ends.count(0.0) > 1:
                lows, owns, ends = _joined(lows, owns, ends)
        return [bound, factor, offset, lows, owns, ends]

    def through(self, chart: list, start: State) -> State:
        bound, factor, offset, lows, owns, ends = chart
        e = start[0]
        if e < bound or not lows:
            return (factor * e + offset,)
        return (ends[owns[max(bisect_right(lows, e) - 1, 0)]],)


def _joined(lows: list, owns: list, ends: list) -> tuple[list, list, list]:
    """Pieces with equal numbers share one; neighbours that do are one piece."""
    place: dict[float, int] = {}
    kept_lows, kept_owns = [], []
    for low, own in zip(lows, owns, strict=True):
        number = place.setdefault(ends[own], len(place))
        if not kept_owns or kept_owns[-1] != number:
            kept_lows.append(low)
            kept_owns.append(number)
    return kept_lows, kept_owns, list(place)


@dataclass(frozen=True)
class Streak(_Shifted):
    """Number of bad outcomes in a row up to each outcome; a good one sets it to 0."""

    inputs = ("bad",)
    outputs = (("streak", "long"),)

    def first(self) -> State:
        return (0,)

    def segment(self, columns: list[list], state: State) -> tuple[list[list], State]:
        bad = np.asarray(columns[0], dtype=bool)
        place = np.arange(1, len(bad) + 1)
        # Place of the last good outcome so far; before the first one the streak goes on from the state.
        good = np.maximum.accumulate(np.where(bad, 0, place))
        streak = place - good + np.where(good == 0, state[0], 0)
        return [streak.tolist()], (int(streak[-1]),)

    def through(self, chart: list, start: State) -> State:
        rows, end = chart
        return (start[0] + rows if end == rows else end,)
