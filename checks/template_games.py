"""Template games of the derived inputs, and the positions they lead to.

The table was made once with the plain move generator of the tests, which reproduces the published perft
counts, and is kept as text so that the oracle needs no chess at all.
"""

# One game per line, in SAN: mate; threefold repetition; stalemate; en passant and under-promotion with castling
# on both wings' rights; trades down to fewer than seven pieces.
GAMES = [
    "e4 e5 Nf3 d6 d4 Bg4 dxe5 Bxf3 Qxf3 dxe5 Bc4 Nf6 Qb3 Qe7 Nc3 c6 Bg5 b5 Nxb5 cxb5 Bxb5+ Nbd7 O-O-O Rd8 Rxd7 Rxd7 Rd1 Qe6 Bxd7+ Nxd7 Qb8+ Nxb8 Rd8#",
    "e4 e5 Nf3 Nc6 Bb5 a6 Ba4 Nf6 O-O Be7 Re1 b5 Bb3 d6 c3 O-O Ng5 Ng4 Nf3 Nf6 Ng5 Ng4 Nf3 Nf6 h3",
    "e3 a5 Qh5 Ra6 Qxa5 h5 h4 Rah6 Qxc7 f6 Qxd7+ Kf7 Qxb7 Qd3 Qxb8 Qh7 Qxc8 Kg6 Qe6",
    "e4 a6 e5 d5 exd6 Nf6 dxc7 Nc6 cxd8=N g6 Nxb7 Bg7 a4 O-O c4 Bxb7 d4 Rad8 d5 e5 dxe6 fxe6",
    "Na3 c5 Nf3 b5 Nxb5 Nc6 Nxa7 Rxa7 Rb1 Rxa2 e4 Rxb2 Rxb2 Nb8 Rxb8 f6 Rxc8 Qxc8 e5 fxe5 Nxe5 d6 Bd3 dxe5 Bxh7 Rxh7 Rf1 Rxh2 g4 Rxf2 Rxf2 Qxg4 Qxg4 c4 Qxc4 Nf6 Rxf6 exf6 Qc6+ Kf7 Qxf6+ gxf6 Bb2 Bh6 Bxe5 Bxd2+ Kxd2",
]

# template|half-move|FEN|pieces|position ends the game
POSITIONS = """
0|1|rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq e3 0 1|32|false
0|2|rnbqkbnr/pppp1ppp/8/4p3/4P3/8/PPPP1PPP/RNBQKBNR w KQkq e6 0 2|32|false
0|3|rnbqkbnr/pppp1ppp/8/4p3/4P3/5N2/PPPP1PPP/RNBQKB1R b KQkq - 1 2|32|false
0|4|rnbqkbnr/ppp2ppp/3p4/4p3/4P3/5N2/PPPP1PPP/RNBQKB1R w KQkq - 0 3|32|false
0|5|rnbqkbnr/ppp2ppp/3p4/4p3/3PP3/5N2/PPP2PPP/RNBQKB1R b KQkq d3 0 3|32|false
0|6|rn1qkbnr/ppp2ppp/3p4/4p3/3PP1b1/5N2/PPP2PPP/RNBQKB1R w KQkq - 1 4|32|false
0|7|rn1qkbnr/ppp2ppp/3p4/4P3/4P1b1/5N2/PPP2PPP/RNBQKB1R b KQkq - 0 4|31|false
0|8|rn1qkbnr/ppp2ppp/3p4/4P3/4P3/5b2/PPP2PPP/RNBQKB1R w KQkq - 0 5|30|false
0|9|rn1qkbnr/ppp2ppp/3p4/4P3/4P3/5Q2/PPP2PPP/RNB1KB1R b KQkq - 0 5|29|false
0|10|rn1qkbnr/ppp2ppp/8/4p3/4P3/5Q2/PPP2PPP/RNB1KB1R w KQkq - 0 6|28|false
0|11|rn1qkbnr/ppp2ppp/8/4p3/2B1P3/5Q2/PPP2PPP/RNB1K2R b KQkq - 1 6|28|false
0|12|rn1qkb1r/ppp2ppp/5n2/4p3/2B1P3/5Q2/PPP2PPP/RNB1K2R w KQkq - 2 7|28|false
0|13|rn1qkb1r/ppp2ppp/5n2/4p3/2B1P3/1Q6/PPP2PPP/RNB1K2R b KQkq - 3 7|28|false
0|14|rn2kb1r/ppp1qppp/5n2/4p3/2B1P3/1Q6/PPP2PPP/RNB1K2R w KQkq - 4 8|28|false
0|15|rn2kb1r/ppp1qppp/5n2/4p3/2B1P3/1QN5/PPP2PPP/R1B1K2R b KQkq - 5 8|28|false
0|16|rn2kb1r/pp2qppp/2p2n2/4p3/2B1P3/1QN5/PPP2PPP/R1B1K2R w KQkq - 0 9|28|false
0|17|rn2kb1r/pp2qppp/2p2n2/4p1B1/2B1P3/1QN5/PPP2PPP/R3K2R b KQkq - 1 9|28|false
0|18|rn2kb1r/p3qppp/2p2n2/1p2p1B1/2B1P3/1QN5/PPP2PPP/R3K2R w KQkq b6 0 10|28|false
0|19|rn2kb1r/p3qppp/2p2n2/1N2p1B1/2B1P3/1Q6/PPP2PPP/R3K2R b KQkq - 0 10|27|false
0|20|rn2kb1r/p3qppp/5n2/1p2p1B1/2B1P3/1Q6/PPP2PPP/R3K2R w KQkq - 0 11|26|false
0|21|rn2kb1r/p3qppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/R3K2R b KQkq - 0 11|25|false
0|22|r3kb1r/p2nqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/R3K2R w KQkq - 1 12|25|false
0|23|r3kb1r/p2nqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/2KR3R b kq - 2 12|25|false
0|24|3rkb1r/p2nqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/2KR3R w k - 3 13|25|false
0|25|3rkb1r/p2Rqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/2K4R b k - 0 13|24|false
0|26|4kb1r/p2rqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/2K4R w k - 0 14|23|false
0|27|4kb1r/p2rqppp/5n2/1B2p1B1/4P3/1Q6/PPP2PPP/2KR4 b k - 1 14|23|false
0|28|4kb1r/p2r1ppp/4qn2/1B2p1B1/4P3/1Q6/PPP2PPP/2KR4 w k - 2 15|23|false
0|29|4kb1r/p2B1ppp/4qn2/4p1B1/4P3/1Q6/PPP2PPP/2KR4 b k - 0 15|22|false
0|30|4kb1r/p2n1ppp/4q3/4p1B1/4P3/1Q6/PPP2PPP/2KR4 w k - 0 16|21|false
0|31|1Q2kb1r/p2n1ppp/4q3/4p1B1/4P3/8/PPP2PPP/2KR4 b k - 1 16|21|false
0|32|1n2kb1r/p4ppp/4q3/4p1B1/4P3/8/PPP2PPP/2KR4 w k - 0 17|20|false
0|33|1n1Rkb1r/p4ppp/4q3/4p1B1/4P3/8/PPP2PPP/2K5 b k - 1 17|20|true
1|1|rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq e3 0 1|32|false
1|2|rnbqkbnr/pppp1ppp/8/4p3/4P3/8/PPPP1PPP/RNBQKBNR w KQkq e6 0 2|32|false
1|3|rnbqkbnr/pppp1ppp/8/4p3/4P3/5N2/PPPP1PPP/RNBQKB1R b KQkq - 1 2|32|false
1|4|r1bqkbnr/pppp1ppp/2n5/4p3/4P3/5N2/PPPP1PPP/RNBQKB1R w KQkq - 2 3|32|false
1|5|r1bqkbnr/pppp1ppp/2n5/1B2p3/4P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 3 3|32|false
1|6|r1bqkbnr/1ppp1ppp/p1n5/1B2p3/4P3/5N2/PPPP1PPP/RNBQK2R w KQkq - 0 4|32|false
1|7|r1bqkbnr/1ppp1ppp/p1n5/4p3/B3P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 1 4|32|false
1|8|r1bqkb1r/1ppp1ppp/p1n2n2/4p3/B3P3/5N2/PPPP1PPP/RNBQK2R w KQkq - 2 5|32|false
1|9|r1bqkb1r/1ppp1ppp/p1n2n2/4p3/B3P3/5N2/PPPP1PPP/RNBQ1RK1 b kq - 3 5|32|false
1|10|r1bqk2r/1pppbppp/p1n2n2/4p3/B3P3/5N2/PPPP1PPP/RNBQ1RK1 w kq - 4 6|32|false
1|11|r1bqk2r/1pppbppp/p1n2n2/4p3/B3P3/5N2/PPPP1PPP/RNBQR1K1 b kq - 5 6|32|false
1|12|r1bqk2r/2ppbppp/p1n2n2/1p2p3/B3P3/5N2/PPPP1PPP/RNBQR1K1 w kq b6 0 7|32|false
1|13|r1bqk2r/2ppbppp/p1n2n2/1p2p3/4P3/1B3N2/PPPP1PPP/RNBQR1K1 b kq - 1 7|32|false
1|14|r1bqk2r/2p1bppp/p1np1n2/1p2p3/4P3/1B3N2/PPPP1PPP/RNBQR1K1 w kq - 0 8|32|false
1|15|r1bqk2r/2p1bppp/p1np1n2/1p2p3/4P3/1BP2N2/PP1P1PPP/RNBQR1K1 b kq - 0 8|32|false
1|16|r1bq1rk1/2p1bppp/p1np1n2/1p2p3/4P3/1BP2N2/PP1P1PPP/RNBQR1K1 w - - 1 9|32|false
1|17|r1bq1rk1/2p1bppp/p1np1n2/1p2p1N1/4P3/1BP5/PP1P1PPP/RNBQR1K1 b - - 2 9|32|false
1|18|r1bq1rk1/2p1bppp/p1np4/1p2p1N1/4P1n1/1BP5/PP1P1PPP/RNBQR1K1 w - - 3 10|32|false
1|19|r1bq1rk1/2p1bppp/p1np4/1p2p3/4P1n1/1BP2N2/PP1P1PPP/RNBQR1K1 b - - 4 10|32|false
1|20|r1bq1rk1/2p1bppp/p1np1n2/1p2p3/4P3/1BP2N2/PP1P1PPP/RNBQR1K1 w - - 5 11|32|false
1|21|r1bq1rk1/2p1bppp/p1np1n2/1p2p1N1/4P3/1BP5/PP1P1PPP/RNBQR1K1 b - - 6 11|32|false
1|22|r1bq1rk1/2p1bppp/p1np4/1p2p1N1/4P1n1/1BP5/PP1P1PPP/RNBQR1K1 w - - 7 12|32|false
1|23|r1bq1rk1/2p1bppp/p1np4/1p2p3/4P1n1/1BP2N2/PP1P1PPP/RNBQR1K1 b - - 8 12|32|false
1|24|r1bq1rk1/2p1bppp/p1np1n2/1p2p3/4P3/1BP2N2/PP1P1PPP/RNBQR1K1 w - - 9 13|32|true
1|25|r1bq1rk1/2p1bppp/p1np1n2/1p2p3/4P3/1BP2N1P/PP1P1PP1/RNBQR1K1 b - - 0 13|32|false
2|1|rnbqkbnr/pppppppp/8/8/8/4P3/PPPP1PPP/RNBQKBNR b KQkq - 0 1|32|false
2|2|rnbqkbnr/1ppppppp/8/p7/8/4P3/PPPP1PPP/RNBQKBNR w KQkq a6 0 2|32|false
2|3|rnbqkbnr/1ppppppp/8/p6Q/8/4P3/PPPP1PPP/RNB1KBNR b KQkq - 1 2|32|false
2|4|1nbqkbnr/1ppppppp/r7/p6Q/8/4P3/PPPP1PPP/RNB1KBNR w KQk - 2 3|32|false
2|5|1nbqkbnr/1ppppppp/r7/Q7/8/4P3/PPPP1PPP/RNB1KBNR b KQk - 0 3|31|false
2|6|1nbqkbnr/1pppppp1/r7/Q6p/8/4P3/PPPP1PPP/RNB1KBNR w KQk h6 0 4|31|false
2|7|1nbqkbnr/1pppppp1/r7/Q6p/7P/4P3/PPPP1PP1/RNB1KBNR b KQk h3 0 4|31|false
2|8|1nbqkbnr/1pppppp1/7r/Q6p/7P/4P3/PPPP1PP1/RNB1KBNR w KQk - 1 5|31|false
2|9|1nbqkbnr/1pQpppp1/7r/7p/7P/4P3/PPPP1PP1/RNB1KBNR b KQk - 0 5|30|false
2|10|1nbqkbnr/1pQpp1p1/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR w KQk - 0 6|30|false
2|11|1nbqkbnr/1p1Qp1p1/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR b KQk - 0 6|29|false
2|12|1nbq1bnr/1p1Qpkp1/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR w KQ - 1 7|29|false
2|13|1nbq1bnr/1Q2pkp1/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR b KQ - 0 7|28|false
2|14|1nb2bnr/1Q2pkp1/5p1r/7p/7P/3qP3/PPPP1PP1/RNB1KBNR w KQ - 1 8|28|false
2|15|1Qb2bnr/4pkp1/5p1r/7p/7P/3qP3/PPPP1PP1/RNB1KBNR b KQ - 0 8|27|false
2|16|1Qb2bnr/4pkpq/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR w KQ - 1 9|27|false
2|17|2Q2bnr/4pkpq/5p1r/7p/7P/4P3/PPPP1PP1/RNB1KBNR b KQ - 0 9|26|false
2|18|2Q2bnr/4p1pq/5pkr/7p/7P/4P3/PPPP1PP1/RNB1KBNR w KQ - 1 10|26|false
2|19|5bnr/4p1pq/4Qpkr/7p/7P/4P3/PPPP1PP1/RNB1KBNR b KQ - 2 10|26|true
3|1|rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq e3 0 1|32|false
3|2|rnbqkbnr/1ppppppp/p7/8/4P3/8/PPPP1PPP/RNBQKBNR w KQkq - 0 2|32|false
3|3|rnbqkbnr/1ppppppp/p7/4P3/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 2|32|false
3|4|rnbqkbnr/1pp1pppp/p7/3pP3/8/8/PPPP1PPP/RNBQKBNR w KQkq d6 0 3|32|false
3|5|rnbqkbnr/1pp1pppp/p2P4/8/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 3|31|false
3|6|rnbqkb1r/1pp1pppp/p2P1n2/8/8/8/PPPP1PPP/RNBQKBNR w KQkq - 1 4|31|false
3|7|rnbqkb1r/1pP1pppp/p4n2/8/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 4|30|false
3|8|r1bqkb1r/1pP1pppp/p1n2n2/8/8/8/PPPP1PPP/RNBQKBNR w KQkq - 1 5|30|false
3|9|r1bNkb1r/1p2pppp/p1n2n2/8/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 5|29|false
3|10|r1bNkb1r/1p2pp1p/p1n2np1/8/8/8/PPPP1PPP/RNBQKBNR w KQkq - 0 6|29|false
3|11|r1b1kb1r/1N2pp1p/p1n2np1/8/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 6|28|false
3|12|r1b1k2r/1N2ppbp/p1n2np1/8/8/8/PPPP1PPP/RNBQKBNR w KQkq - 1 7|28|false
3|13|r1b1k2r/1N2ppbp/p1n2np1/8/P7/8/1PPP1PPP/RNBQKBNR b KQkq a3 0 7|28|false
3|14|r1b2rk1/1N2ppbp/p1n2np1/8/P7/8/1PPP1PPP/RNBQKBNR w KQ - 1 8|28|false
3|15|r1b2rk1/1N2ppbp/p1n2np1/8/P1P5/8/1P1P1PPP/RNBQKBNR b KQ c3 0 8|28|false
3|16|r4rk1/1b2ppbp/p1n2np1/8/P1P5/8/1P1P1PPP/RNBQKBNR w KQ - 0 9|27|false
3|17|r4rk1/1b2ppbp/p1n2np1/8/P1PP4/8/1P3PPP/RNBQKBNR b KQ d3 0 9|27|false
3|18|3r1rk1/1b2ppbp/p1n2np1/8/P1PP4/8/1P3PPP/RNBQKBNR w KQ - 1 10|27|false
3|19|3r1rk1/1b2ppbp/p1n2np1/3P4/P1P5/8/1P3PPP/RNBQKBNR b KQ - 0 10|27|false
3|20|3r1rk1/1b3pbp/p1n2np1/3Pp3/P1P5/8/1P3PPP/RNBQKBNR w KQ e6 0 11|27|false
3|21|3r1rk1/1b3pbp/p1n1Pnp1/8/P1P5/8/1P3PPP/RNBQKBNR b KQ - 0 11|26|false
3|22|3r1rk1/1b4bp/p1n1pnp1/8/P1P5/8/1P3PPP/RNBQKBNR w KQ - 0 12|25|false
4|1|rnbqkbnr/pppppppp/8/8/8/N7/PPPPPPPP/R1BQKBNR b KQkq - 1 1|32|false
4|2|rnbqkbnr/pp1ppppp/8/2p5/8/N7/PPPPPPPP/R1BQKBNR w KQkq c6 0 2|32|false
4|3|rnbqkbnr/pp1ppppp/8/2p5/8/N4N2/PPPPPPPP/R1BQKB1R b KQkq - 1 2|32|false
4|4|rnbqkbnr/p2ppppp/8/1pp5/8/N4N2/PPPPPPPP/R1BQKB1R w KQkq b6 0 3|32|false
4|5|rnbqkbnr/p2ppppp/8/1Np5/8/5N2/PPPPPPPP/R1BQKB1R b KQkq - 0 3|31|false
4|6|r1bqkbnr/p2ppppp/2n5/1Np5/8/5N2/PPPPPPPP/R1BQKB1R w KQkq - 1 4|31|false
4|7|r1bqkbnr/N2ppppp/2n5/2p5/8/5N2/PPPPPPPP/R1BQKB1R b KQkq - 0 4|30|false
4|8|2bqkbnr/r2ppppp/2n5/2p5/8/5N2/PPPPPPPP/R1BQKB1R w KQk - 0 5|29|false
4|9|2bqkbnr/r2ppppp/2n5/2p5/8/5N2/PPPPPPPP/1RBQKB1R b Kk - 1 5|29|false
4|10|2bqkbnr/3ppppp/2n5/2p5/8/5N2/rPPPPPPP/1RBQKB1R w Kk - 0 6|28|false
4|11|2bqkbnr/3ppppp/2n5/2p5/4P3/5N2/rPPP1PPP/1RBQKB1R b Kk e3 0 6|28|false
4|12|2bqkbnr/3ppppp/2n5/2p5/4P3/5N2/1rPP1PPP/1RBQKB1R w Kk - 0 7|27|false
4|13|2bqkbnr/3ppppp/2n5/2p5/4P3/5N2/1RPP1PPP/2BQKB1R b Kk - 0 7|26|false
4|14|1nbqkbnr/3ppppp/8/2p5/4P3/5N2/1RPP1PPP/2BQKB1R w Kk - 1 8|26|false
4|15|1Rbqkbnr/3ppppp/8/2p5/4P3/5N2/2PP1PPP/2BQKB1R b Kk - 0 8|25|false
4|16|1Rbqkbnr/3pp1pp/5p2/2p5/4P3/5N2/2PP1PPP/2BQKB1R w Kk - 0 9|25|false
4|17|2Rqkbnr/3pp1pp/5p2/2p5/4P3/5N2/2PP1PPP/2BQKB1R b Kk - 0 9|24|false
4|18|2q1kbnr/3pp1pp/5p2/2p5/4P3/5N2/2PP1PPP/2BQKB1R w Kk - 0 10|23|false
4|19|2q1kbnr/3pp1pp/5p2/2p1P3/8/5N2/2PP1PPP/2BQKB1R b Kk - 0 10|23|false
4|20|2q1kbnr/3pp1pp/8/2p1p3/8/5N2/2PP1PPP/2BQKB1R w Kk - 0 11|22|false
4|21|2q1kbnr/3pp1pp/8/2p1N3/8/8/2PP1PPP/2BQKB1R b Kk - 0 11|21|false
4|22|2q1kbnr/4p1pp/3p4/2p1N3/8/8/2PP1PPP/2BQKB1R w Kk - 0 12|21|false
4|23|2q1kbnr/4p1pp/3p4/2p1N3/8/3B4/2PP1PPP/2BQK2R b Kk - 1 12|21|false
4|24|2q1kbnr/4p1pp/8/2p1p3/8/3B4/2PP1PPP/2BQK2R w Kk - 0 13|20|false
4|25|2q1kbnr/4p1pB/8/2p1p3/8/8/2PP1PPP/2BQK2R b Kk - 0 13|19|false
4|26|2q1kbn1/4p1pr/8/2p1p3/8/8/2PP1PPP/2BQK2R w K - 0 14|18|false
4|27|2q1kbn1/4p1pr/8/2p1p3/8/8/2PP1PPP/2BQKR2 b - - 1 14|18|false
4|28|2q1kbn1/4p1p1/8/2p1p3/8/8/2PP1PPr/2BQKR2 w - - 0 15|17|false
4|29|2q1kbn1/4p1p1/8/2p1p3/6P1/8/2PP1P1r/2BQKR2 b - g3 0 15|17|false
4|30|2q1kbn1/4p1p1/8/2p1p3/6P1/8/2PP1r2/2BQKR2 w - - 0 16|16|false
4|31|2q1kbn1/4p1p1/8/2p1p3/6P1/8/2PP1R2/2BQK3 b - - 0 16|15|false
4|32|4kbn1/4p1p1/8/2p1p3/6q1/8/2PP1R2/2BQK3 w - - 0 17|14|false
4|33|4kbn1/4p1p1/8/2p1p3/6Q1/8/2PP1R2/2B1K3 b - - 0 17|13|false
4|34|4kbn1/4p1p1/8/4p3/2p3Q1/8/2PP1R2/2B1K3 w - - 0 18|13|false
4|35|4kbn1/4p1p1/8/4p3/2Q5/8/2PP1R2/2B1K3 b - - 0 18|12|false
4|36|4kb2/4p1p1/5n2/4p3/2Q5/8/2PP1R2/2B1K3 w - - 1 19|12|false
4|37|4kb2/4p1p1/5R2/4p3/2Q5/8/2PP4/2B1K3 b - - 0 19|11|false
4|38|4kb2/6p1/5p2/4p3/2Q5/8/2PP4/2B1K3 w - - 0 20|10|false
4|39|4kb2/6p1/2Q2p2/4p3/8/8/2PP4/2B1K3 b - - 1 20|10|false
4|40|5b2/5kp1/2Q2p2/4p3/8/8/2PP4/2B1K3 w - - 2 21|10|false
4|41|5b2/5kp1/5Q2/4p3/8/8/2PP4/2B1K3 b - - 0 21|9|false
4|42|5b2/5k2/5p2/4p3/8/8/2PP4/2B1K3 w - - 0 22|8|false
4|43|5b2/5k2/5p2/4p3/8/8/1BPP4/4K3 b - - 1 22|8|false
4|44|8/5k2/5p1b/4p3/8/8/1BPP4/4K3 w - - 2 23|8|false
4|45|8/5k2/5p1b/4B3/8/8/2PP4/4K3 b - - 0 23|7|false
4|46|8/5k2/5p2/4B3/8/8/2Pb4/4K3 w - - 0 24|6|false
4|47|8/5k2/5p2/4B3/8/8/2PK4/8 b - - 0 24|5|false
"""
