"""FEN text: dedup key, board expansion, validity, and the 64-token encoding.

Boards are 64-character strings, a8 first, '.' for an empty square. All steps are string expressions, so
a board never becomes 64 separate rows or a Python object.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plyforge.schemas import SQUARES

EMPTY_RUNS = [(str(n), "." * n) for n in range(8, 0, -1)]
RUN_COUNTS = [
    ("....", "4"), ("...", "3"), ("..", "2"), (".", "1"), ("44", "8"), ("43", "7"), ("42", "6"), ("41", "5"),
]

# One letter per token, 'a' = token 0 ... 'p' = token 15.
#   0 empty, 1 en-passant pawn, 2/3 pawn, 4/5 knight, 6/7 bishop, 8/9 rook, 10/11 castling rook,
#   12/13 queen, 14/15 king (ours / theirs)
PIECE_CHARS = ".PpNnBbRrQqKk"
TOKENS_FOR_WHITE = "acdefghijmnop"
TOKENS_FOR_BLACK = "adcfehgjinmpo"
EN_PASSANT_TOKEN = "b"
OUR_CASTLING_ROOK, THEIR_CASTLING_ROOK = "k", "l"


def fen_field(fen: Column, n: int) -> Column:
    """The n-th space-separated field of a FEN, counted from 1."""
    return F.split_part(fen, F.lit(" "), F.lit(n))


def position_key(fen: Column) -> Column:
    """Placement, side, castling and en passant: what makes two positions the same position."""
    return F.substring_index(fen, " ", 4)


def white_to_move(fen: Column) -> Column:
    return fen_field(fen, 2) == "w"


def expand_ranks(placement: Column) -> Column:
    """Placement with digits written out as dots; the rank separators stay."""
    return reduce(lambda text, run: F.replace(text, F.lit(run[0]), F.lit(run[1])), EMPTY_RUNS, placement)


def fen_to_board(fen: Column) -> Column:
    return F.replace(expand_ranks(fen_field(fen, 1)), F.lit("/"), F.lit(""))


def board_to_placement(board: Column) -> Column:
    """Placement text. Empty runs are first counted in fours, threes, twos and ones, then joined."""
    ranks = [F.substring(board, 8 * r + 1, 8) for r in range(8)]
    separated = F.concat(ranks[0], *[part for rank in ranks[1:] for part in (F.lit("/"), rank)])
    return reduce(lambda text, run: F.replace(text, F.lit(run[0]), F.lit(run[1])), RUN_COUNTS, separated)


def valid_fen(fen: Column) -> Column:
    """Eight ranks of eight known pieces, and legal side, castling and en-passant fields."""
    ranks = expand_ranks(fen_field(fen, 1))
    good = (
        ranks.rlike(r"^([.PNBRQKpnbrqk]{8}/){7}[.PNBRQKpnbrqk]{8}$")
        & fen_field(fen, 2).isin("w", "b")
        & fen_field(fen, 3).rlike(r"^(-|(?=.)K?Q?k?q?)$")
        & fen_field(fen, 4).rlike(r"^(-|[a-h][36])$")
    )
    return F.coalesce(good, F.lit(False))


def piece_tokens(board: Column, white: Column) -> Column:
    """Token letters of the pieces alone, a1 first as the mover sees it.

    White reads the ranks bottom up; Black's mirrored view is the a8-first board as it stands.
    """
    a1_first = F.concat(*[F.substring(board, 8 * r + 1, 8) for r in range(7, -1, -1)])
    return F.when(white, F.translate(a1_first, PIECE_CHARS, TOKENS_FOR_WHITE)).otherwise(
        F.translate(board, PIECE_CHARS, TOKENS_FOR_BLACK)
    )


def with_castling(tokens: Column, castling: Column, white: Column) -> Column:
    """Overwrite the corner squares of every castling right held, whatever stands there."""

    def right(white_letter: str, black_letter: str) -> Column:
        return F.when(white, castling.contains(white_letter)).otherwise(castling.contains(black_letter))

    def corner(position: int, held: Column, token: str) -> Column:
        return F.when(held, F.lit(token)).otherwise(F.substring(tokens, position, 1))

    return F.concat(
        corner(1, right("Q", "q"), OUR_CASTLING_ROOK),
        F.substring(tokens, 2, 6),
        corner(8, right("K", "k"), OUR_CASTLING_ROOK),
        F.substring(tokens, 9, 48),
        corner(57, right("q", "Q"), THEIR_CASTLING_ROOK),
        F.substring(tokens, 58, 6),
        corner(64, right("k", "K"), THEIR_CASTLING_ROOK),
    )


def capturable_file(tokens: Column, en_passant: Column) -> Column:
    """File 1-8 of an en-passant pawn that one of our pawns stands next to, else null.

    Seen by the mover that pawn is always on the fifth rank, characters 33 to 40; the empty tokens put
    around the rank stand for the board's edges.
    """
    file = F.instr(F.lit("abcdefgh"), F.substring(en_passant, 1, 1))
    fifth = F.concat(F.lit("a"), F.substring(tokens, 33, 8), F.lit("a"))
    beside = (F.substr(fifth, file, F.lit(1)) == "c") | (F.substr(fifth, file + 2, F.lit(1)) == "c")
    return F.when((en_passant != "-") & beside, file)


def with_en_passant(tokens: Column, file: Column) -> Column:
    """Overwrite the capturable en-passant pawn, if there is one."""
    marked = F.overlay(tokens, F.lit(EN_PASSANT_TOKEN), (file + 32).cast("int"), F.lit(1))
    return F.when(file.isNotNull(), marked).otherwise(tokens)


def token_array(tokens: Column) -> Column:
    """Token letters as array<tinyint>, null unless there are 64 of them."""
    values = F.transform(F.split(tokens, ""), lambda c: (F.ascii(c) - ord("a")).cast("tinyint"))
    return F.when(F.length(tokens) == SQUARES, values)


def fen_text(
    placement: Column, white: Column, castling: Column, en_passant: Column, halfmove_clock: Column, ply: Column
) -> Column:
    """A full FEN from the columns of a replayed half-move."""
    return F.concat_ws(
        " ", placement, F.when(white, "w").otherwise("b"), castling, en_passant,
        halfmove_clock.cast("string"), (F.floor(ply / 2) + 1).cast("string"),
    )


# Bishops on one square colour only, for either colour, beside the kings.
LIGHT_BISHOPS = r"^(?:(?:[.KkBb][.Kk]){4}(?:[.Kk][.KkBb]){4}){4}$"
DARK_BISHOPS = r"^(?:(?:[.Kk][.KkBb]){4}(?:[.KkBb][.Kk]){4}){4}$"


def insufficient_material(board: Column, piece_count: Column) -> Column:
    """No side can ever mate: a lone minor piece, or only bishops of one square colour."""
    return (
        ((piece_count <= 3) & ~board.rlike("[PRQprq]")) | board.rlike(LIGHT_BISHOPS) | board.rlike(DARK_BISHOPS)
    )
