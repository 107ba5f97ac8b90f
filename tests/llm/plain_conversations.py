"""Slow versions of the repair of conversations and of their prefix trie, straight from the definitions."""

import hashlib
import heapq
import math
import re
import zlib

from tests.llm.plain import WORD

SHOWN = re.compile("[^\x20\x09-\x0d]")
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def _digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def _in_order(rows, size=32):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, _digest(r[1], r[2])[:size]))


def damage(conv, turn, role, text):
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = (" " if x is None else x for x in (role, text))
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows, faults):
    """(cost, audit, repaired lines) of the cheapest edits with the least audit, by Dijkstra's search over (row, state)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        added = [(letter, to) for letter, to in NEXT[state].items() if letter != "s"]
        for letter, to in added:
            heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*lines, NAMES[letter] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if faults[i] in (None, "truncated"):
                more = 5 if faults[i] else 0
                if role[:1] in NEXT[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, NEXT[state][role[:1]], (*lines, f"{role}:{text}")))
                for letter, to in added:
                    heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, to, (*lines, f"{NAMES[letter]}:{text}")))


def repairs(table):
    """{conv_id: the other columns} from rows (conv_id, turn, role, text)."""
    found = {}
    for row in table:
        found.setdefault(row[0], []).extend(damage(*row))
    out = {}
    for conv, rows in found.items():
        rows = _in_order(rows)
        seen, faults = set(), []
        for _, role, text in rows:
            shown = SHOWN.findall(text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit, lines = cheapest(rows, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def trie(table):
    """The rows of the prefix trie, from rows (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in table:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    own = {c: [r[1:] for r in _in_order(rows, 16)] for c, rows in own.items()}
    built = {}
    for conv, rows in own.items():
        taken = zlib.crc32(str(conv).encode()) % 4
        built[conv] = (*own.get(conv - int(math.fmod(conv, 20)), [])[:taken], *rows[taken:])
    nodes, kids = {}, {}
    for conv, rows in built.items():
        for d in range(len(rows) + 1):
            nodes.setdefault(rows[:d], []).append(conv)
    for prefix in nodes:
        if prefix:
            kids.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(nodes, key=len, reverse=True):
        below = kids.get(prefix, [])
        leaves[prefix] = sum(leaves[b] for b in below) or 1
        words = len(WORD.findall(prefix[-1][1])) if prefix else 0
        saved[prefix] = (len(nodes[prefix]) - 1) * words + sum(saved[b] for b in below)
    return [(
        min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(kids.get(prefix, [])), leaves[prefix], saved[prefix],
        hashlib.sha256(",".join(str(c) for c in sorted(members) if len(built[c]) == len(prefix)).encode()).hexdigest(),
    ) for prefix, members in nodes.items()]
