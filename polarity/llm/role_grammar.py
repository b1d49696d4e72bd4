"""Generalised LR repair of a sequence of roles.

An SLR table is made from a small grammar over role initials.  The repair
walks the rows with a graph-structured stack: nodes (state, node below) are
shared, every row shifts, reroles or deletes, symbols may be inserted
anywhere, and stacks that become equal merge to the least (cost, audit).
Because the grammar is left-recursive its stacks stay flat, so all nodes can
be numbered once and every step (tops with their relative costs, in the order
of their audits, and the next row) is computed once and remembered.
"""

from __future__ import annotations

import heapq

# dialogue = [system] (user assistant)+, or nothing.
DIALOGUE = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "Pua"), ("P", "ua"))
END = "$"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3               # more for a truncated row that stays
FREE = "ua"                 # what a rerole or an insert may give
GONE = "x"                  # the symbol of a row that must go; else its initial, "?" for one unknown to the
                            # grammar; in upper case, or "!", when truncated
MOST_STACKS, MOST_KNOWN = 10_000, 1 << 16


class Table:
    """SLR actions of a grammar; a cell may hold several (the stack then forks)."""

    def __init__(self, grammar=DIALOGUE):
        self.rules = (("^", grammar[0][0]), *grammar)
        heads = {h for h, _ in grammar}
        self.terminals = sorted({x for _, body in grammar for x in body} - heads)
        follow = self._follow(heads)
        states = [self._closure({(0, 0)}, heads)]
        self.goto, self.reduce, self.accept = {}, {}, set()
        for at, items in enumerate(states):         # grows while it is read
            after: dict[str, set] = {}
            for rule, dot in items:
                head, body = self.rules[rule]
                if dot < len(body):
                    after.setdefault(body[dot], set()).add((rule, dot + 1))
                elif rule == 0:
                    self.accept.add(at)
                else:
                    for t in follow[head]:
                        self.reduce.setdefault((at, t), []).append(rule)
            for symbol, kernel in sorted(after.items()):
                target = self._closure(kernel, heads)
                if target not in states:
                    states.append(target)
                self.goto[at, symbol] = states.index(target)

    def _closure(self, items, heads):
        out, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in heads:
                new = {(i, 0) for i, (h, _) in enumerate(self.rules) if h == body[dot]} - out
                out |= new
                todo += new
        return frozenset(out)

    def _follow(self, heads):
        empty, first, follow = set(), {h: set() for h in heads}, {h: set() for h in heads}
        follow[self.rules[0][1]].add(END)
        while True:
            size = len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))
            for head, body in self.rules[1:]:
                begin = True
                for i, x in enumerate(body):
                    if begin:
                        first[head] |= first.get(x, {x})
                    begin = begin and x in empty
                    if x in heads:
                        rest = body[i + 1:]
                        for y in rest:
                            follow[x] |= first.get(y, {y})
                            if y not in empty:
                                break
                        else:
                            follow[x] |= follow[head]
                if begin:
                    empty.add(head)
            if size == len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values())):
                return follow

    def shifted(self, stack, terminal):
        """Stacks after ``terminal``, all reductions that it calls for included;
        for END the accepted ones."""
        out, todo = [], [stack]
        while todo:
            top = todo.pop()
            state = top[0]
            if terminal == END and state in self.accept:
                out.append(top)
            if (state, terminal) in self.goto:
                out.append((self.goto[state, terminal], top))
            for rule in self.reduce.get((state, terminal), ()):
                head, body = self.rules[rule]
                below = top
                for _ in body:
                    below = below[1]
                todo.append((self.goto[below[0], head], below))
        return out


class Repairer:
    """Cheapest repairs under a grammar; ties go to the ASCII-least audit."""

    def __init__(self, grammar=DIALOGUE):
        table = Table(grammar)
        stacks, number = [(0, None)], {(0, None): 0}
        self.moves: list[dict[str, list[int]]] = []
        for stack in stacks:                        # grows while it is read
            step = {}
            for t in table.terminals:
                found = table.shifted(stack, t)
                for new in found:
                    if new not in number:
                        number[new] = len(stacks)
                        stacks.append(new)
                if found:
                    step[t] = [number[new] for new in found]
            self.moves.append(step)
            if len(stacks) > MOST_STACKS:
                raise ValueError("the grammar's stacks don't stay flat")
        self.final = [bool(table.shifted(stack, END)) for stack in stacks]
        symbols = [GONE, "?", "!", *table.terminals, *[t.upper() for t in table.terminals]]
        self.lead = self._leads({x: [self._row(stack, x) for stack in range(len(stacks))] for x in symbols})
        self.known: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def _row(self, stack, symbol):
        """(stack, cost, letter) for each way to take a row."""
        out = [(stack, COST[DELETE], DELETE)]
        if symbol != GONE:
            extra = TRUNCATED * (symbol.isupper() or symbol == "!")
            out += [(new, COST[KEEP] + extra, KEEP) for new in self.moves[stack].get(symbol.lower(), ())]
            out += [(new, COST[REROLE] + extra, REROLE) for t in FREE for new in self.moves[stack].get(t, ())]
        return out

    def _with_inserts(self, tops):
        """Least (cost, order of the audit so far, inserted letters) of every
        stack within reach of ``tops`` by inserts."""
        heap = [(cost, order, "", stack) for order, (stack, cost) in enumerate(tops)]
        heapq.heapify(heap)
        best = {}
        while heap:
            cost, order, letters, stack = heapq.heappop(heap)
            if stack in best:
                continue
            best[stack] = (cost, order, letters)
            for t in FREE:
                for new in self.moves[stack].get(t, ()):
                    if new not in best:
                        heapq.heappush(heap, (cost + COST[INSERT], order, letters + INSERT, new))
        return best

    def _leads(self, rows):
        """lead[y][x]: whatever rows follow, going on from y costs at most so
        much more than going on from x.

        A game in which x moves and y answers; the values of games of growing
        length, from 0 on, until they stay (None: they never do).
        """
        n = len(self.moves)
        near = [{s: f[0] for s, f in self._with_inserts([(y, 0)]).items()} for y in range(n)]
        inserted = [[new for t in FREE for new in self.moves[x].get(t, ())] for x in range(n)]
        lead = [[0 if self.final[x] is False else min((c for s, c in near[y].items() if self.final[s]), default=1 << 20)
                 for x in range(n)] for y in range(n)]
        for _ in range(100):
            new = [[max([lead[y][x], *[lead[y][i] - COST[INSERT] for i in inserted[x]],
                         *[min(c + more + lead[to][at] - cost for s, c in near[y].items() for to, more, _ in row[s])
                           for row in rows.values() for at, cost, _ in row[x]]])
                    for x in range(n)] for y in range(n)]
            if new == lead:
                return lead
            lead = new
        return None

    def step(self, tops, symbol):
        """(new tops, where each came from, cost taken out of all of them).

        ``tops`` are (stack, cost) in the order of their audits.  All of these
        audits end with the same row, so none begins another one and the order
        of longer audits follows from (order, letters added).  A top that an
        insert reaches as well, or that can't win any more, is left out.
        """
        found = self.known.get((tops, symbol))
        if found is None:
            if len(self.known) > MOST_KNOWN:
                self.known.clear()
            found = self.known[tops, symbol] = self._step(tops, symbol)
        return found

    def _step(self, tops, symbol):
        merged = {}
        for stack, (cost, order, letters) in self._with_inserts(tops).items():
            for new, more, letter in self._row(stack, symbol):
                way = (cost + more, order, letters + letter)
                if new not in merged or way < merged[new]:
                    merged[new] = way
        least = min(cost for cost, _, _ in merged.values())
        ranked = sorted(merged.items(), key=lambda kv: kv[1][1:])
        own = self._with_inserts([(stack, way[0]) for stack, way in ranked])
        ranked = [(stack, way) for stack, way in ranked if own[stack][2] == "" and not (self.lead and any(
            other[0] + self.lead[y][stack] < way[0] for y, other in merged.items()))]
        return (tuple((stack, cost - least) for stack, (cost, _, _) in ranked),
                tuple((order, letters) for _, (_, order, letters) in ranked), least)

    def repair(self, pieces: list[str]) -> tuple[int, str]:
        """(cost, audit) of the rows whose symbols are in ``pieces``.

        The way back is recomputed piece by piece, so only the symbols, the
        tops between pieces and the audit are held.
        """
        tops, spent, begun = ((0, 0),), 0, []
        for piece in pieces:
            begun.append(tops)
            for symbol in piece:
                tops, _, least = self.step(tops, symbol)
                spent += least
        cost, at, letters = min(found for stack, found in self._with_inserts(tops).items() if self.final[stack])
        audit = [letters]
        for piece, tops in zip(reversed(pieces), reversed(begun)):
            ways = []
            for symbol in piece:
                tops, links, _ = self.step(tops, symbol)
                ways.append(links)
            own = []
            for links in reversed(ways):
                at, letters = links[at]
                own.append(letters)
            audit.append("".join(reversed(own)))
        return spent + cost, "".join(reversed(audit))
