"""A bounded store of what a worker has already tokenised."""

from __future__ import annotations

MOST = 400_000


class Store:
    """Values of text units, each put together from the values of its parts.

    ``of`` cuts a unit into ``parts(unit)``, gives the ``values`` of a list of parts at
    once, and the value ``joined`` from several. Units and parts are kept in two
    generations of bounded size; what was not asked for during a whole generation is
    forgotten.
    """

    def __init__(self, of, most: int = MOST):
        self.of, self.most = of, most
        self.done: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}
        self.part: dict[str, tuple] = {}
        self.part_before: dict[str, tuple] = {}

    def of_units(self, units: list[str]) -> list[tuple]:
        """The values of the units."""
        distinct = set(units)
        new = distinct.difference(self.done)
        if new:
            self.add(new, distinct)
        return [*map(self.done.__getitem__, units)]

    def add(self, new: set[str], needed: set[str]) -> None:
        """Puts units into the store that are not in it. If it is full, all that are ``needed`` move to the new generation."""
        if len(self.done) + len(new) > self.most:
            self.before, self.done = self.done, {}
            new = needed
        done, before = self.done, self.before
        cut: dict[str, list[str]] = {}
        for u in new:
            had = before.get(u)
            if had is None:
                cut[u] = self.of.parts(u)
            else:
                done[u] = had
        if not cut:
            return
        known = self.part
        if len(known) > self.most:
            self.part_before, self.part = known, {}
            known = self.part
        asked = []
        for p in {p for ps in cut.values() for p in ps}.difference(known):
            had = self.part_before.get(p)
            if had is None:
                asked.append(p)
            else:
                known[p] = had
        known.update(zip(asked, self.of.values(asked) if asked else []))
        for u, ps in cut.items():
            done[u] = known[ps[0]] if len(ps) == 1 else self.of.joined([known[p] for p in ps])
