"""One team through one game: who is on the floor, from evidence of presence and from substitutions.

Two facts place a player: an *act* (something only a player on the floor does, which includes leaving it) and an *arrival*. Looking
forward from any moment, a player whose next act comes before the next arrival is on the floor at that moment. Acts and arrivals
of a period are kept per player as rising row numbers, so a look forward is one search per player, and a lineup that cannot be told is
only asked for again after a row that could change the answer.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass, field

FULL = 5

# Names under which notes are published.
INFERRED = "period_starters_inferred"
COMPLETED = "period_starters_completed_from_previous_period"
UNRESOLVED_START = "period_starters_unresolved"
NEXT_SEEN = "subs_resolved_by_lookahead"
UNRESOLVED_SUB = "subs_unresolved"
RECOVERED = "lineups_recovered_mid_period"


@dataclass
class Moment:
    """Where a segment may begin: log position, clock, and the latest clock so far."""

    ord: int
    t: int
    floor: int


@dataclass
class Row:
    """One event that concerns the team. ``after`` is the next event of either side in the period."""

    at: Moment
    after: Moment | None
    swap: bool
    outs: list[int]
    ins: list[int]
    named: bool
    meant: list[int]          # everyone the spoken name may mean
    actor: int | None         # on the floor for sure
    shown: int | None         # mentioned at all


class Evidence:
    """Acts, arrivals and mentions of one period, by row number."""

    def __init__(self, rows: list[Row], team: set[int]):
        self.acts, self.arrivals, self.mentions = defaultdict(list), defaultdict(list), defaultdict(list)
        self.swaps = [i for i, row in enumerate(rows) if row.swap]
        for i, row in enumerate(rows):
            leaving = row.outs if row.swap else ()
            acting = leaving if row.swap else (row.actor,) if row.actor is not None else ()
            for p in dict.fromkeys(acting):
                if p in team:
                    self.acts[p].append(i)
            if row.swap:
                for p in {*row.ins, *(set(row.meant) - set(row.outs))}:
                    self.arrivals[p].append(i)
            for rank, p in enumerate((row.shown, *row.outs)):
                if p is not None:
                    self.mentions[p].append((i, rank))

    @staticmethod
    def following(rows: list, i, default=None):
        k = bisect_left(rows, i)
        return rows[k] if k < len(rows) else default

    def sure(self, i: int, absent: set[int]) -> list[tuple[int, int]]:
        """(next act, player) of everyone whose next act comes before the next arrival."""
        never = float("inf")
        sure = []
        for p, acts in self.acts.items():
            act = self.following(acts, i)
            if act is not None and p not in absent and act < self.following(self.arrivals[p], i, never):
                sure.append((act, p))
        sure.sort()
        return sure

    def same_until(self, i: int, absent: set[int]) -> int:
        """The last row before which a lineup that cannot be told before row i cannot be told either.

        Until the next substitution, players only drop out of those sure to be on, each after the last act before the next arrival.
        """
        sure = self.sure(i, absent)
        if len(sure) >= FULL:
            return i
        ends = [acts[bisect_left(acts, self.following(self.arrivals[p], i, float("inf"))) - 1] for acts, p in ((self.acts[p], p) for _, p in sure)]
        return min([*ends, self.following(self.swaps, i, float("inf"))])

    def lineup(self, i: int, absent: set[int], previous: set[int] | None) -> tuple[set[int] | None, bool]:
        """(the five on the floor just before row i, whether the previous lineup had to fill it up); None if it cannot be told."""
        sure = self.sure(i, absent)
        if len(sure) > FULL and sure[FULL - 1][0] < sure[FULL][0]:
            sure = sure[:FULL]
        on = {p for _, p in sure}
        if len(on) == FULL:
            return on, False
        if previous is None:
            return None, False
        on |= {p for p in previous if p not in absent and self.following(self.arrivals[p], i) is None}
        return (on, True) if len(on) == FULL else (None, False)

    def first_mentioned(self, players: set[int], i: int) -> int | None:
        found = [(at, p) for p in players if (at := self.following(self.mentions[p], (i, -1))) is not None]
        return min(found)[1] if found else None


@dataclass
class TeamFloor:
    """State carried through the periods of a game; ``segments`` and ``notes`` are its result."""

    team: set[int]
    segments: list[tuple] = field(default_factory=list)
    notes: list[tuple] = field(default_factory=list)
    closing: set[int] | None = None
    confirmed: set[int] | None = None      # the last lineup that an event happened under

    def play(self, period: int, start: int, first: Moment, rows: list[Row], starters: set[int] | None) -> None:
        self.period, self.number, self.gone, self.lost_until = period, 0, set(), -1
        self.evidence = Evidence(rows, self.team)
        self.five = starters
        if starters is None:
            self.five, filled = self.evidence.lineup(0, set(), self.closing)
            self.note(INFERRED)
            if filled:
                self.note(COMPLETED)
            if self.five is None:
                self.note(UNRESOLVED_START)
        self.open(Moment(-1, start, start), True)
        self.on_event(first, 0)
        for i, row in enumerate(rows):
            if row.swap:
                self.change(i, row)
            if row.after is not None:
                self.on_event(row.after, i + 1)
        self.closing = self.five

    def note(self, name: str, detail: str | None = None) -> None:
        self.notes.append((self.period, name, detail))

    def open(self, at: Moment, exact: bool) -> None:
        self.segments.append((self.period, self.number, at.ord, at.t, at.floor, None if self.five is None else sorted(self.five), exact))
        self.number += 1

    def on_event(self, at: Moment, i: int) -> None:
        """An event is about to happen with rows i and on still to come."""
        if self.five is None and i > self.lost_until and self.recover(i):
            self.open(at, False)
        if self.five is not None:
            self.confirmed, self.gone = self.five, set()

    def recover(self, i: int) -> bool:
        stayed = (self.confirmed or set()) - self.gone
        self.five, _ = self.evidence.lineup(i, self.gone, stayed or None)
        if self.five is not None:
            self.note(RECOVERED)
        else:
            self.lost_until = self.evidence.same_until(i, self.gone)
        return self.five is not None

    def change(self, i: int, row: Row) -> None:
        behind = Moment(row.at.ord + 1, row.at.t, row.at.floor)
        was_known, (after, why) = self.five is not None, self.after_swap(i, row)
        if why is None:
            self.five = after
            self.open(behind, True)
            return
        if was_known:
            coming = "an unlisted name" if row.named and not row.meant else sorted({*row.ins, *row.meant})
            self.note(UNRESOLVED_SUB, f"period {self.period}, position {row.at.ord}: {sorted(row.outs)} replaced by {coming}: {why}")
            self.confirmed = self.five
        self.gone |= set(row.outs)
        found = self.recover(i + 1)
        found_five, self.five = self.five, None
        self.open(behind, False)
        if found:
            self.five = self.confirmed = found_five
            self.gone = set()
            self.open(behind, False)

    def after_swap(self, i: int, row: Row) -> tuple[set[int] | None, str | None]:
        """The lineup behind a substitution, or why it has none."""
        if self.five is None:
            return None, "nobody is known to be on"
        coming = [p for p in row.ins if p in self.team]
        if row.named:
            fresh = set(row.meant) - self.five
            if len(fresh) > 1:
                seen = self.evidence.first_mentioned(fresh, i + 1)
                fresh = set() if seen is None else {seen}
                if seen is None:
                    return None, "the name is shared and none of its holders appears later"
                self.note(NEXT_SEEN)
            if not fresh:
                return None, "everyone of that name is on already" if row.meant else "nobody of that name played"
            coming += fresh
        leaving = {p for p in row.outs if p in self.team}
        if not leaving <= self.five:
            return None, "someone leaves who is not on"
        after = (self.five - leaving) | set(coming)
        return (after, None) if len(after) == FULL else (None, f"{len(after)} players would be on")
