"""A plain move generator for the tests: slow, separate from the package, checked by perft counts."""

START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
STEPS = {
    "n": [(1, 2), (2, 1), (-1, 2), (-2, 1), (1, -2), (2, -1), (-1, -2), (-2, -1)],
    "b": [(1, 1), (1, -1), (-1, 1), (-1, -1)],
    "r": [(1, 0), (-1, 0), (0, 1), (0, -1)],
}
STEPS["q"] = STEPS["k"] = STEPS["b"] + STEPS["r"]


class Position:
    def __init__(self, fen=START):
        placement, side, castling, ep, clock, number = fen.split()
        self.at = {}
        for y, rank in zip(range(7, -1, -1), placement.split("/")):
            x = 0
            for c in rank:
                if c.isdigit():
                    x += int(c)
                else:
                    self.at[x, y] = c
                    x += 1
        self.white, self.castling = side == "w", castling.replace("-", "")
        self.ep = None if ep == "-" else ("abcdefgh".index(ep[0]), int(ep[1]) - 1)
        self.clock, self.number = int(clock), int(number)

    def fen(self):
        ranks = []
        for y in range(7, -1, -1):
            text, run = "", 0
            for x in range(8):
                piece = self.at.get((x, y))
                if piece is None:
                    run += 1
                    continue
                text += (str(run) if run else "") + piece
                run = 0
            ranks.append(text + (str(run) if run else ""))
        ep = "-" if self.ep is None else name(self.ep)
        return f"{'/'.join(ranks)} {'w' if self.white else 'b'} {self.castling or '-'} {ep} {self.clock} {self.number}"

    def ours(self, piece):
        return piece is not None and piece.isupper() == self.white

    def is_attacked(self, square, by_white):
        x, y = square
        for kind, steps in STEPS.items():
            for dx, dy in steps:
                a, b, far = x + dx, y + dy, False
                while 0 <= a < 8 and 0 <= b < 8:
                    piece = self.at.get((a, b))
                    if piece:
                        if piece.lower() == kind and piece.isupper() == by_white and not (far and kind in "nk"):
                            return True
                        break
                    a, b, far = a + dx, b + dy, True
        step = -1 if by_white else 1
        return any(self.at.get((x + dx, y + step)) == ("P" if by_white else "p") for dx in (-1, 1))

    def in_check(self):
        king = next(s for s, p in self.at.items() if p == ("K" if self.white else "k"))
        return self.is_attacked(king, not self.white)

    def pseudo(self):
        forward, start, last = (1, 1, 7) if self.white else (-1, 6, 0)
        for (x, y), piece in list(self.at.items()):
            if not self.ours(piece):
                continue
            kind = piece.lower()
            if kind == "p":
                goals = []
                if (x, y + forward) not in self.at:
                    goals.append((x, y + forward))
                    if y == start and (x, y + 2 * forward) not in self.at:
                        goals.append((x, y + 2 * forward))
                for dx in (-1, 1):
                    goal = (x + dx, y + forward)
                    target = self.at.get(goal)
                    if (target and not self.ours(target)) or goal == self.ep:
                        goals.append(goal)
                for goal in goals:
                    for promotion in ("qrbn" if goal[1] == last else [""]):
                        yield (x, y), goal, promotion
                continue
            for dx, dy in STEPS[kind]:
                a, b = x + dx, y + dy
                while 0 <= a < 8 and 0 <= b < 8 and not self.ours(self.at.get((a, b))):
                    yield (x, y), (a, b), ""
                    if (a, b) in self.at or kind in "nk":
                        break
                    a, b = a + dx, b + dy
        home = (4, 0 if self.white else 7)
        for right, path, goal in (("k", (5, 6), 6), ("q", (3, 2, 1), 2)):
            letter = right.upper() if self.white else right
            if letter in self.castling and not any((x, home[1]) in self.at for x in path):
                if not any(self.is_attacked((x, home[1]), not self.white) for x in (4, path[0])):
                    yield home, (goal, home[1]), ""

    def push(self, move):
        (x, y), goal, promotion = move
        new = Position.__new__(Position)
        new.at = dict(self.at)
        piece = new.at.pop((x, y))
        capture = goal in new.at
        if piece.lower() == "p" and goal == self.ep and x != goal[0]:
            del new.at[goal[0], y]
        new.at[goal] = (promotion.upper() if self.white else promotion) if promotion else piece
        if piece.lower() == "k" and abs(goal[0] - x) == 2:
            corner, rook = (7, 5) if goal[0] == 6 else (0, 3)
            new.at[rook, y] = new.at.pop((corner, y))
        lost = {(4, 0): "KQ", (4, 7): "kq", (0, 0): "Q", (7, 0): "K", (0, 7): "q", (7, 7): "k"}
        gone = lost.get((x, y), "") + lost.get(goal, "")
        new.castling = "".join(c for c in self.castling if c not in gone)
        new.ep = (x, (y + goal[1]) // 2) if piece.lower() == "p" and abs(goal[1] - y) == 2 else None
        new.clock = 0 if capture or piece.lower() == "p" else self.clock + 1
        new.white, new.number = not self.white, self.number + (not self.white)
        return new

    def legal(self):
        for move in self.pseudo():
            after = self.push(move)
            after.white = self.white
            if not after.in_check():
                yield move

    def san(self, move):
        (x, y), goal, promotion = move
        kind = self.at[x, y].upper()
        after = self.push(move)
        suffix = ("+" if any(True for _ in after.legal()) else "#") if after.in_check() else ""
        if kind == "K" and abs(goal[0] - x) == 2:
            return ("O-O" if goal[0] == 6 else "O-O-O") + suffix
        takes = goal in self.at or (kind == "P" and x != goal[0])
        if kind == "P":
            text = f"{'abcdefgh'[x]}x{name(goal)}" if takes else name(goal)
            return text + (f"={promotion.upper()}" if promotion else "") + suffix
        rivals = [o for o, g, _ in self.legal() if g == goal and o != (x, y) and self.at[o] == self.at[x, y]]
        mark = ""
        if rivals:
            if all(o[0] != x for o in rivals):
                mark = "abcdefgh"[x]
            elif all(o[1] != y for o in rivals):
                mark = str(y + 1)
            else:
                mark = name((x, y))
        return f"{kind}{mark}{'x' if takes else ''}{name(goal)}{suffix}"

    def find(self, san):
        plain = san.rstrip("+#!?")
        matches = [m for m in self.legal() if self.san(m).rstrip("+#") == plain]
        assert len(matches) == 1, (san, matches, self.fen())
        return matches[0]

    def repetition_key(self):
        forward = 1 if self.white else -1
        ready = self.ep and any(
            self.at.get((self.ep[0] + dx, self.ep[1] - forward)) == ("P" if self.white else "p") for dx in (-1, 1)
        )
        return tuple(sorted(self.at.items())), self.white, self.castling, self.ep if ready else None


def name(square):
    return f"{'abcdefgh'[square[0]]}{square[1] + 1}"


def perft(position, depth):
    if depth == 0:
        return 1
    return sum(perft(position.push(m), depth - 1) for m in position.legal())


def play(sans):
    """(fen, times this position has occurred, no legal move left) after each half-move."""
    position, out = Position(), []
    seen = {position.repetition_key(): 1}
    for san in sans:
        position = position.push(position.find(san))
        key = position.repetition_key()
        seen[key] = seen.get(key, 0) + 1
        out.append((position.fen(), seen[key], next(position.legal(), None) is None))
    return out
