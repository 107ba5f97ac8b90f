"""The same results in DuckDB SQL, on the given tables."""

from checks.catalog import BATCH, CAP, EPOCHS, PIECE_VALUES, SHARDS, WINDOW
from checks.inputs import FILE_ROWS
from checks.template_games import GAMES, POSITIONS
from plyforge.functions.evals import EVAL_PATTERN
from plyforge.schemas import EVAL_SEED, TRAIN_SEED

EVAL = EVAL_PATTERN.replace("'", "''")
ROW_VALUES = ",\n".join(
    "({0}, {1}, '{2}', {3}, {4})".format(*line.split("|")) for line in POSITIONS.strip().splitlines())
GAME_VALUES = ",\n".join(f"({i}, string_split('{g}', ' '))" for i, g in enumerate(GAMES))


def hash_bits(digits, *parts):
    return f"cast('0x' || substr(md5(concat_ws(':', {', '.join(map(str, parts))})), 1, {digits}) as bigint)"


def split(*ids):
    return f"case when {hash_bits(8, repr(str(TRAIN_SEED)), *ids)} < 214748365 then 'test' else 'train' end"


def eval_of(comment):
    pawns, mate = (f"regexp_extract({comment}, '{EVAL}', {i})" for i in (1, 2))
    return f"""case when {pawns} <> '' then cast(greatest(least(trunc(cast({pawns} as double) * 100), 2147483647), -2147483648) as int)
        when {mate} like '-%' then -10000 when {mate} <> '' then 10000 end"""


GAMES_SQL = f"""
template(template, moves) as (values {GAME_VALUES}),
template_ply(template, ply, fen, piece_count, terminal) as (values {ROW_VALUES}),
keyed as (
  select o_orderkey as k, o_orderkey % {len(GAMES)} as template, cast(o_orderkey as varchar) as game_id,
    'archive-' || (o_orderkey % 4) as file, o_orderkey as game_ord,
    cast(case when o_orderkey % 29 = 0 then 0 else o_custkey * 13 % 1000 + 1600 end as int) as white_elo,
    cast(case when o_orderkey % 29 = 0 then 0 else (o_orderkey * 7) % 1000 + 1500 end as int) as black_elo,
    case o_orderstatus when 'F' then '1-0' when 'O' then '0-1'
      else case when o_orderkey % 5 = 0 then '*' else '1/2-1/2' end end as result
  from orders),
half_move as (
  select k, game_id, ply, fen, piece_count, terminal, moves[ply] as san, k % 11 <> 0 as commented,
    case when (k + ply * 3) % 13 = 0 then '{{ [%clk 0:03:00] }}'
      when (k + ply) % 23 = 0
        then '{{ [%eval ' || (case when k % 2 = 1 then '#-' else '#' end) || (ply % 5 + 1) || '] }}'
      when (k + ply) % 101 = 0 then '{{ [%eval ' || (case when k % 2 = 1 then '-' else '' end) || '99999999.00] }}'
      else '{{ [%eval ' || (case when (k * 31 + ply * 17) % 1999 - 999 < 0 then '-' else '' end)
        || (abs((k * 31 + ply * 17) % 1999 - 999) // 100) || '.'
        || lpad(cast(abs((k * 31 + ply * 17) % 1999 - 999) % 100 as varchar), 2, '0') || '] }}' end as comment
  from keyed join template using (template) join template_ply using (template)),
stop as (
  select game_id, coalesce(min(ply) filter (piece_count < 7), 1000) as few,
    coalesce(min(ply) filter (terminal), 1000) as ended from half_move group by game_id),
annotated as (
  select keyed.*, least(white_elo, black_elo) as min_elo,
    case result when '1-0' then 1 when '0-1' then -1 when '1/2-1/2' then 0 end as white_outcome,
    {split('keyed.game_id')} as set_type
  from keyed join half_move on keyed.k = half_move.k and half_move.ply = 11
  where least(white_elo, black_elo) >= 2000 and result <> '*' and commented
    and regexp_matches(comment, '{EVAL}')),
position as (
  select a.game_id, a.k, a.file, a.game_ord, h.ply, h.fen, {eval_of('h.comment')} as eval, a.min_elo,
    a.white_outcome, a.set_type, array_to_string(string_split(h.fen, ' ')[1:4], ' ') as key
  from annotated a join half_move h using (k) join stop s on s.game_id = a.game_id
  where h.ply > 10 and h.ply < s.few and h.ply < s.ended and {eval_of('h.comment')} is not null)"""

MOVETEXT_SQL = """
movetext as (
  select k, string_agg((case when ply % 2 = 1 then ((ply - 1) // 2 + 1) || '. ' else '' end) || san
    || (case when commented then ' ' || comment else '' end), ' ' order by ply) as body from half_move group by k),
record as (
  select keyed.*, body || ' ' || result as movetext,
    '[Event "Rated game"]' || chr(10) || '[Site "' || game_id || '"]' || chr(10) || '[Result "' || result || '"]'
    || chr(10) || '[WhiteElo "' || (case when white_elo = 0 then '?' else cast(white_elo as varchar) end) || '"]'
    || chr(10) || '[BlackElo "' || (case when black_elo = 0 then '?' else cast(black_elo as varchar) end) || '"]'
    || chr(10) || chr(10) || body || ' ' || result as pgn
  from keyed join movetext using (k))"""


def games(select, extra=""):
    return f"with {GAMES_SQL}{',' + extra if extra else ''} {select}"


def placement(board):
    text = " || '/' || ".join(f"substr({board}, {8 * r + 1}, 8)" for r in range(8))
    for n in range(8, 0, -1):
        text = f"replace({text}, '{'.' * n}', '{n}')"
    return text


def board_cte(name="board", repeated=False, faulty=False):
    k = "user_id" if repeated else "event_id"
    seed = "concat_ws('-', user_id, event_type)" if repeated else "cast(event_id as varchar)"
    fen = f"""concat_ws(' ', {placement('b64')}, case when {k} % 2 = 0 then 'w' else 'b' end,
      case when {k} % 16 = 0 then '-' else
        (case when {k} % 2 = 1 then 'K' else '' end) || (case when {k} % 4 >= 2 then 'Q' else '' end)
        || (case when {k} % 8 >= 4 then 'k' else '' end) || (case when {k} % 16 >= 8 then 'q' else '' end) end,
      case when {k} % 3 = 0 then substr('abcdefgh', cast({k} % 8 + 1 as int), 1)
        || (case when {k} % 2 = 0 then '6' else '3' end) else '-' end, '0', '1')"""
    if faulty:
        fen = f"""case when event_id % 37 = 0 then regexp_replace({fen}, '^[^/]*/', '')
          when event_id % 41 = 0 then replace({fen}, ' w ', ' x ')
          when event_id % 43 = 0 then 'Z' || {fen} else {fen} end"""
    return f"""{name} as (
  select event_id, event_type as file, user_id as game_ord, cast(event_id as int) as ply, {fen} as fen,
    cast(trunc(value * 100) as int) - 5000 as eval, cast(event_id % 500 + 2000 as int) as min_elo,
    cast(event_id % 3 - 1 as int) as white_outcome, {split('event_id')} as set_type
  from (select *, translate(md5({seed}) || md5('b' || {seed}), '0123456789abcdef', '....PNBRQKpnbrqk') as b64
        from events))"""


# Encoding square by square, written from the token table rather than from string layers.
def token_cte(source, name="encoded", castling=True, en_passant=True, keep="*"):
    board = "string_split(fen, ' ')[1]"
    for n in range(8, 0, -1):
        board = f"replace({board}, '{n}', '{'.' * n}')"
    corners = " ".join(
        f"when {'true' if castling else 'false'} and contains(castling, '{letter}') and i = {square} then {token}"
        for letter, square, token in (
            ("K", "case when white then 7 else 63 end", "case when white then 10 else 11 end"),
            ("Q", "case when white then 0 else 56 end", "case when white then 10 else 11 end"),
            ("k", "case when white then 63 else 7 end", "case when white then 11 else 10 end"),
            ("q", "case when white then 56 else 0 end", "case when white then 11 else 10 end")))
    return f"""{name}_1 as (
  select {keep}, replace({board}, '/', '') as board, string_split(fen, ' ')[2] = 'w' as white,
    string_split(fen, ' ')[3] as castling, string_split(fen, ' ')[4] as ep from {source}),
{name}_2 as (
  select *, case when ep <> '-' then ascii(ep) - 97 end as ep_file,
    case when white then board else translate(board, 'PNBRQKpnbrqk', 'pnbrqkPNBRQK') end as mine from {name}_1),
{name}_3 as (
  select *, case when white then 24 else 32 end as fifth from {name}_2),
{name} as (
  select * exclude (board, white, castling, ep, ep_file, mine, fifth),
    array_to_string(list_transform(range(0, 64), lambda i: case
      when {'true' if en_passant else 'false'} and ep_file is not null and i = 32 + ep_file and (
        (ep_file > 0 and substr(mine, fifth + ep_file, 1) = 'P')
        or (ep_file < 7 and substr(mine, fifth + ep_file + 2, 1) = 'P')) then 1
      {corners}
      else case substr(mine, cast(case when white then xor(i, 56) else i end as int) + 1, 1)
        when 'P' then 2 when 'p' then 3 when 'N' then 4 when 'n' then 5 when 'B' then 6 when 'b' then 7
        when 'R' then 8 when 'r' then 9 when 'Q' then 12 when 'q' then 13 when 'K' then 14 when 'k' then 15
        else 0 end end), ',') as features
  from {name}_3)"""


def tokens(castling, en_passant):
    return f"""with {board_cte()}, {token_cte('board', castling=castling, en_passant=en_passant)}
select event_id, features from encoded"""


SIGN = "(case when string_split(fen, ' ')[2] = 'w' then 1 else -1 end)"
OPPOSITE = f"cast(case when eval = -2147483648 then eval else {SIGN} * eval end as int)"
RECORD = f"""fen, features, {OPPOSITE} as eval, cast({SIGN} * white_outcome as int) as outcome,
  cast(min_elo as int) as "minElo", set_type as "setType\""""
GOOD = "(event_id % 37 <> 0 and case when event_id % 41 = 0 then event_id % 2 <> 0 else event_id % 43 <> 0 end)"


def records(where="true", faulty=False, columns=None):
    return f"""with {board_cte(faulty=faulty)}, fine as (select * from board where {where}), {token_cte('fine')},
record as (select {RECORD} from encoded) select {columns or '*'} from record"""


def rows_cte(features=False):
    source = f"{board_cte()}, {token_cte('board')}" if features else board_cte()
    return f"""{source}, data_row as (
  select 'part-' || lpad(cast(event_id // {FILE_ROWS} as varchar), 8, '0') as file, event_id % {FILE_ROWS} as row_index,
    eval{', features' if features else ''} from {'encoded' if features else 'board'}),
data_file as (select file, count(*) as rows from data_row group by file)"""


PLAN = f"""ordered as (
  select file, rows, row_number() over (order by {hash_bits(15, repr(str(TRAIN_SEED)), 'file')}, file) - 1 as ord
  from data_file),
plan as (
  select file, rows, ord, cast(epoch as int) as epoch, epoch * (select count(*) from data_file) + ord as pos,
    cast((epoch * (select count(*) from data_file) + ord) % {SHARDS} as int) as shard
  from ordered, range({EPOCHS}) e(epoch))"""

WINDOWS = f"""{PLAN},
filled as (
  select shard, pos, epoch, file, rows, 0 as window_index, rows as filled from plan where pos < {SHARDS}
  union all
  select p.shard, p.pos, p.epoch, p.file, p.rows,
    case when f.filled >= {WINDOW} then f.window_index + 1 else f.window_index end,
    case when f.filled >= {WINDOW} then p.rows else f.filled + p.rows end
  from filled f join plan p on p.shard = f.shard and p.pos = f.pos + {SHARDS}),
windows as (
  select shard, pos, epoch, file, rows, window_index,
    cast(sum(rows) over (partition by shard, window_index) as bigint) as window_size from filled)"""

SHUFFLED = f"""{WINDOWS},
shuffled as (
  select r.*, w.* exclude (file, rows), row_number() over (
    partition by shard, window_index
    order by {hash_bits(15, repr(str(TRAIN_SEED)), 'shard', 'window_index', 'pos', 'row_index')}, pos, row_index) as rn
  from data_row r join windows w on r.file = w.file),
batch as (
  select *, (rn - 1) // {BATCH} as batch_index from shuffled where (rn - 1) // {BATCH} < window_size // {BATCH})"""

PLACE = "shard, window_index, batch_index, rn, file, row_index, epoch"


def rows(select, plan, features=False):
    return f"with recursive {rows_cte(features)}, {plan} {select}"


UNIQUE = """row_number() over (partition by key order by file, game_ord, ply) = 1"""

ORACLE: dict[str, str] = {
    "games_from_pgn": games(
        "select md5(pgn) as game_id, file, game_ord, white_elo, black_elo, result, movetext from record", MOVETEXT_SQL),
    "filter_min_elo": games(
        "select game_id, least(white_elo, black_elo) as min_elo from keyed where least(white_elo, black_elo) >= 2000"),
    "decode_outcome": games(
        "select game_id, case result when '1-0' then 1 when '0-1' then -1 else 0 end as white_outcome from keyed "
        "where result <> '*'"),
    "filter_commented": games(
        "select game_id, cast(len(moves) as int) as n from keyed join template using (template) where k % 11 <> 0"),
    "annotation_gate": games(
        f"select game_id from half_move where ply = 11 and commented and regexp_matches(comment, '{EVAL}')"),
    "split_by_game": games(f"select game_id, {split('game_id')} as set_type from keyed"),
    "replay_positions": games("select game_id, cast(ply as int) as ply, fen, piece_count, terminal from half_move"),
    "extract_eval": games(
        f"select game_id, cast(ply as int) as ply, case when commented then {eval_of('comment')} end as eval "
        "from half_move"),
    "stop_min_pieces": games("select game_id, ply, fen from half_move join stop using (game_id) where ply < few"),
    "stop_terminal": games("select game_id, ply, fen from half_move join stop using (game_id) where ply < ended"),
    "prefix_until": games(
        "select game_id, ply, fen from half_move join stop using (game_id) where ply < few and ply < ended"),
    "skip_opening": games("select game_id, ply, fen from half_move where ply > 10"),
    "game_positions": games("select game_id, ply, fen, eval, min_elo, white_outcome, set_type from position"),
    "position_key": f"with {board_cte()} "
        "select event_id, array_to_string(string_split(fen, ' ')[1:4], ' ') as key from board",
    "to_mover_pov": f"with {board_cte()} select event_id, cast({SIGN} * eval as int) as eval, "
        f"cast({SIGN} * white_outcome as int) as outcome from board",
    "encode_rejects": f"with {board_cte(faulty=True)} select event_id, fen from board where not {GOOD}",
    "fen_to_board": """select event_id, translate(md5(cast(event_id as varchar)) || md5('b' || event_id),
        '0123456789abcdef', '....PNBRQKpnbrqk') as board from events""",
    "encode_pieces": tokens(False, False),
    "encode_castling": tokens(True, False),
    "encode_en_passant": tokens(False, True),
    "encode_fen": tokens(True, True),
    "training_records": records(GOOD, faulty=True),
    "dedup_first_wins": f"""with {board_cte(repeated=True)},
      keyed as (select *, array_to_string(string_split(fen, ' ')[1:4], ' ') as key from board)
      select key, file, game_ord, ply, eval from keyed qualify {UNIQUE}""",
    "cap_positions": f"with {board_cte()} "
        f"select file, game_ord, ply, fen from board order by file, game_ord, ply limit {CAP}",
    "stage_counts": games("""select count(*) as games,
      count(*) filter (least(white_elo, black_elo) >= 2000) as rated,
      count(*) filter (least(white_elo, black_elo) >= 2000 and result <> '*') as decided,
      count(*) filter (least(white_elo, black_elo) >= 2000 and result <> '*' and k % 11 <> 0) as commented,
      (select count(*) from annotated) as annotated, (select count(*) from position) as positions,
      (select count(distinct key) from position) as unique_positions from keyed"""),
    "count_by_split": f"with {board_cte()} select set_type as \"setType\", count(*) as rows from board group by 1",
    "run_sizing": f"""with {board_cte()}, t as (select count(*) as train_rows from board where set_type = 'train')
      select train_rows, cast(1000000 // {BATCH} as bigint) as iterations,
        cast(ceil(1000000.0 / train_rows) as bigint) as epochs,
        (train_rows - 1) // {BATCH} + 1 as steps_per_epoch, cast(2097152 // {BATCH} as bigint) as validation_freq
      from t""",
    "eval_metrics": f"""with {board_cte()},
      scored as (select event_id as row_id, (event_id % 2001 - 1000) / 250.0 as logit,
        1 / (1 + exp(-eval / 400.0)) as label from board),
      ranked as (select *, row_number() over (order by {hash_bits(15, repr(str(EVAL_SEED)), 'row_id')}, row_id) as rn,
        count(*) over () as n from scored),
      kept as (select *, 1 / (1 + exp(-logit)) as p from ranked where (rn - 1) // {BATCH} < n // {BATCH})
      select round(avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))), 6) as loss,
        round(avg(cast(p > 0.8 as int)), 6) as winning_ratio, round(avg(cast(p < 0.2 as int)), 6) as losing_ratio,
        count(*) as rows from kept""",
    "step_rollup": f"""with s as (select event_id as step, value as loss, value / 50 as grad_norm,
        (event_id % 7 + 1) / 100.0 as seconds, max(event_id) over () as last from events),
      g as (select least(cast(ceil(step / 128.0) * 128 as bigint), last) as ended_at, * from s)
      select ended_at as step, ended_at * {BATCH} as boards, round(ended_at / 157.0, 6) as epoch, round(avg(loss), 10) as train_loss,
        round(avg(grad_norm), 10) as train_grad_norm,
        round(avg(cast(grad_norm > 1.0 as int)), 8) as train_grad_clipped,
        round(count(*) * {BATCH} / sum(seconds), 6) as boards_per_second
      from g group by ended_at""",
    "dataset_digest": f"""with {rows_cte()}, listing as (
        select case when right(file, 1) < '5' then 'train' else 'test' end as split, file as name, rows * 64 as length
        from data_file)
      select 'boards-' || split as source,
        substr(sha256(string_agg(name || ':' || length, '' order by name)), 1, 8) as digest
      from listing group by split""",
    "scan_projected": records(columns="features, eval"),
    "scan_split": records("set_type = 'test'"),
    "write_records": records(),
    "eval_sample": f"""with {rows_cte()},
      pool as (select * from data_row order by file, row_index limit 4000)
      select file, row_index, eval from pool
      order by {hash_bits(15, repr(str(EVAL_SEED)), 'file', 'row_index')}, file, row_index limit 1024""",
    "file_order": rows("select file, rows, ord from ordered", PLAN),
    "epoch_plan": rows("select file, rows, ord, epoch, pos, shard from plan", PLAN),
    "plan_windows": rows("select shard, pos, epoch, file, rows, window_index, window_size from windows", WINDOWS),
    "window_shuffle": rows(
        "select file, row_index, eval, shard, pos, epoch, window_index, window_size, rn from shuffled", SHUFFLED),
    "fixed_batches": rows(f"select {PLACE} from batch", SHUFFLED),
    "batch_shortfall": rows(
        f"""select cast(sum(window_size // {BATCH}) as bigint) as batches, cast(1000 as bigint) as iterations,
          greatest(1000 - cast(sum(window_size // {BATCH}) as bigint), 0) as missing
        from (select distinct shard, window_index, window_size from windows)""", WINDOWS),
    "check_feature_width": f"""with {rows_cte(True)}
      select file, row_index, eval, features from data_row where row_index % 97 <> 0""",
    "win_prob_label": f"with {board_cte()} "
        "select event_id, round(cast(cast(1 / (1 + exp(-eval / 400.0)) as float) as double), 5) as label from board",
    "resume_batches": rows(
        f"""select {PLACE} from batch where case shard
          when 0 then (window_index, batch_index) >= (1, 3) when 1 then (window_index, batch_index) >= (0, 20)
          when 2 then (window_index, batch_index) >= (2, 0) else true end""", SHUFFLED),
    "training_batches": rows(
        """select shard, window_index, batch_index, rn, features,
          round(cast(cast(1 / (1 + exp(-eval / 400.0)) as float) as double), 5) as label from batch""",
        SHUFFLED, features=True),
    "score_boards": f"""with {board_cte()}, {token_cte('board')},
      scored as (select event_id, cast(list_sum(list_transform(string_split(features, ','),
        lambda t: {PIECE_VALUES}[cast(t as int) + 1])) as double) as logit from encoded)
      select event_id, logit, round(1 / (1 + exp(-logit)), 6) as probability from scored""",
    "incremental_new_keys": games(f"""select fen, file, game_ord, ply, eval from position p
      where not exists (select 1 from position q where q.k % 5 < 2 and q.key = p.key)
      qualify {UNIQUE}"""),
    "malformed_games": games("select file, game_ord, 5 as failed_ply from annotated where k % 37 = 0"),
    "build_stats": games("""select count(distinct key) filter (k % 37 <> 0) as unique_positions,
      (select count(*) from annotated where k % 37 = 0) as malformed_games from position"""),
    "evaluate_sample": f"""with {rows_cte(True)},
      pool as (select * from data_row order by file, row_index limit 4000),
      ranked as (select *, {hash_bits(15, repr(str(EVAL_SEED)), 'file', 'row_index')} as h from pool),
      sample as (select * from ranked order by h, file, row_index limit 1024),
      scored as (select cast(1 / (1 + exp(-eval / 400.0)) as float) as label, row_number() over (order by h, file || ':' || row_index) as rn,
        count(*) over () as n, cast(list_sum(list_transform(string_split(features, ','), lambda t: {PIECE_VALUES}[cast(t as int) + 1])) as double) as logit
        from sample),
      kept as (select *, 1 / (1 + exp(-logit)) as p from scored where (rn - 1) // {BATCH} < n // {BATCH})
      select cast(128 as bigint) as step, count(*) as rows,
        round(avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))), 5) as loss,
        round(avg(cast(p > 0.8 as int)), 5) as winning_ratio, round(avg(cast(p < 0.2 as int)), 5) as losing_ratio
      from kept""",
    "export_by_budget": rows(
        f"""select shard, window_index, batch_index, rows, cast(1 as bigint) as files from (
          select *, row_number() over (order by seq, shard) as place from (
            select shard, window_index, batch_index, count(*) as rows,
              row_number() over (partition by shard order by window_index, batch_index) as seq
            from batch group by shard, window_index, batch_index))
        where place <= (2 * (select count(*) from data_row) - 300) // {BATCH}""", SHUFFLED),
    "archive_listing": games("""select file || '.pgn.zst' as file, row_number() over (order by file) as place, games
      from (select file, count(*) as games from record group by file)""", MOVETEXT_SQL),
    "archive_scan": games("""select md5(pgn) as game_id, file || '.pgn.zst' as file, white_elo, black_elo, result, movetext
      from record""", MOVETEXT_SQL),
    "train_files": f"with {board_cte()} select set_type as split, count(*) as rows from board where set_type = 'train' group by 1",
    "split_files": f"with {board_cte()} select set_type as split, count(*) as rows from board group by 1",
    "output_guard": f"""with {board_cte()} select unnest(['missing', 'empty', 'written']) as state, unnest([true, true, false]) as allowed,
      unnest([0, 0, (select count(*) from board)]) as rows""",
    "file_layout": f"with {board_cte()} select set_type as \"setType\", count(*) as rows, true as bounded from board group by 1",
    "metrics_history": f"""with s as (select event_id as step, value as loss, value / 50 as grad_norm, max(event_id) over () as last from events),
      g as (select least(cast(ceil(step / 128.0) * 128 as bigint), last) as ended_at, * from s)
      select ended_at as step, round(round(ended_at / 157.0, 5), 4) as epoch, round(avg(loss), 10) as train_loss, round(avg(grad_norm), 10) as train_grad_norm,
        round(avg(cast(grad_norm > 1.0 as int)), 10) as train_grad_clipped, round(ended_at / 8.0, 10) as test_loss,
        round(ended_at / 16.0, 10) as test_winning_ratio, round(ended_at / 32.0, 10) as test_losing_ratio
      from g group by ended_at""",
    "build_dataset": f"""with {GAMES_SQL}, {MOVETEXT_SQL},
      found as (
        select p.* exclude (set_type), {split('md5(r.pgn)')} as set_type from position p join record r using (k)),
      kept as (select * from found qualify row_number() over (partition by key order by k, ply) = 1),
      {token_cte('kept')}
      select {RECORD} from encoded""",
}
