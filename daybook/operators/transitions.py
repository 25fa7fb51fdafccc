"""The focus timer's effect on a stretch of events, for every state it may start in.

A state is what the timer keeps between events: idle, awaiting the check-in, running to
a deadline, paused with seconds left, or on a break until a time.  What a
stretch of events makes of a state depends on at most one number, so it is a piecewise
constant function of that number (or leaves the state as it is).  The pieces are
few: a break ends within its length of the stretch's start, a run within the work
length, and equal results are one piece.  Stretches are put together by applying them in turn.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

SECOND = 1_000_000
SAME = "same"  # the state's own task

IDLE = ("idle", 0, None)
# States: (kind, number, task); the number is a deadline, a break's end (microseconds) or seconds left.


def _ceil_s(us: int) -> int:
    return -(-us // SECOND)


class Stretch:
    """Events (t, action, task) in order, for work and break lengths in seconds."""

    def __init__(self, events: list[tuple], work_s: int, break_s: int):
        self.times = [e[0] for e in events]
        self.work_s, self.break_s = work_s, break_s
        n = self.n = len(events)
        self.after = {a: [n] * (n + 1) for a in ("pause", "resume", "stop")}
        for a, places in self.after.items():
            for i in range(n - 1, -1, -1):
                places[i] = i if events[i][1] == a else places[i + 1]
        # result of being idle, or awaiting the check-in, just before event i
        self.idle, self.awaiting = [IDLE] * (n + 1), [("awaiting", 0, SAME)] * (n + 1)
        for i in range(n - 1, -1, -1):
            t, action, task = events[i]
            self.idle[i], self.awaiting[i] = self.idle[i + 1], self.awaiting[i + 1]
            if action == "start" and task:
                kind, number, own = self.running(i + 1, t + work_s * SECOND)
                self.idle[i] = (kind, number, task if own == SAME else own)
            elif action == "stop":
                self.awaiting[i] = self.idle[i + 1]
            elif action == "checkin":
                self.awaiting[i] = self.resting(i + 1, t + break_s * SECOND)

    def resting(self, i: int, until: int) -> tuple:
        over, stop = max(i, bisect_left(self.times, until)), self.after["stop"][i]
        if stop < over:
            return self.idle[stop + 1]
        return self.idle[over] if over < self.n else ("break", until, SAME)

    def running(self, i: int, deadline: int) -> tuple:
        while True:
            done = max(i, bisect_left(self.times, deadline))
            pause, stop = self.after["pause"][i], self.after["stop"][i]
            if done < self.n and done <= min(pause, stop):
                return self.awaiting[done]
            if stop < pause:
                return self.idle[stop + 1]
            if pause == self.n:
                return "running", deadline, SAME
            left = _ceil_s(deadline - self.times[pause])
            i, resume, stop = pause + 1, self.after["resume"][pause + 1], self.after["stop"][pause + 1]
            if stop < resume:
                return self.idle[stop + 1]
            if resume == self.n:
                return "paused", left, SAME
            i, deadline = resume + 1, self.times[resume] + left * SECOND

    def paused(self, left: int) -> tuple:
        resume, stop = self.after["resume"][0], self.after["stop"][0]
        if stop < resume:
            return self.idle[stop + 1]
        if resume == self.n:
            return "paused", left, SAME
        return self.running(resume + 1, self.times[resume] + left * SECOND)

    def summary(self) -> dict:
        """The function of the stretch, for :func:`follow`."""
        first = self.times[0]
        breaks = [t for t in self.times if t <= first + self.break_s * SECOND]
        # up to the first pause a run ends at an event; beyond it, the seconds left at the pause count
        pause = self.after["pause"][0]
        runs = self.times[: pause + 1]
        late = bisect_left(runs, first + self.work_s * SECOND)  # no run lasts beyond this event
        if late < len(runs):
            runs = runs[: late + 1]
        elif pause < self.n:
            runs = runs + [self.times[pause] + s * SECOND for s in range(1, self.work_s + 1)]
        return {
            "idle": self.idle[0],
            "awaiting": self.awaiting[0],
            "break": _pieces((t, self.resting(0, t)) for t in breaks),
            "break_beyond": self.resting(0, breaks[-1] + 1),
            "running": _pieces((t, self.running(0, t)) for t in dict.fromkeys(runs)),
            "running_beyond": self.running(0, runs[-1] + 1),
            "paused": _pieces((s, self.paused(s)) for s in range(self.work_s + 1)),
        }


def _pieces(results: Iterable[tuple[int, tuple]]) -> list[list]:
    """[[up to this number, result], ...] with equal neighbours joined."""
    out: list[list] = []
    for number, result in results:
        if out and out[-1][1] == list(result):
            out[-1][0] = number
        else:
            out.append([number, list(result)])
    return out


def follow(summary: dict, state: tuple) -> tuple:
    """The state after a stretch."""
    kind, number, task = state
    if kind in ("idle", "awaiting"):
        found = summary[kind]
    else:
        pieces = summary[kind]
        at = bisect_left(pieces, number, key=lambda piece: piece[0])
        found = pieces[at][1] if at < len(pieces) else summary[f"{kind}_beyond"]
        if at == len(pieces) and found[0] == kind and found[2] == SAME:
            return state  # nothing in the stretch touches it
    return found[0], found[1], task if found[2] == SAME else found[2]
