"""``oracle_sql()``: DuckDB texts whose results equal those of ``queries()``."""

from __future__ import annotations

from ..fixed_values import MATCH_LINK, PLAYER_LINK, TEMPLATES
from .derived import sql_raw

# The metrics over the short columns of ``raw``, in DuckDB's terms.
METRIC_SQL = {
    "jungle_kills": "dragon_kills + baron_kills",
    "interceptor": "obj_stolen + obj_stolen_ast",
    "guard_angel": "heals_team + shields_team",
    "gold_unspent": "gold_earned - gold_spent",
    "immortal": "CASE WHEN deaths = 0 AND kills + assists >= 10 THEN 1 ELSE 0 END",
    "flash_casts": "(CASE WHEN spell1_id = 4 THEN spell1_casts ELSE 0 END)"
    " + (CASE WHEN spell2_id = 4 THEN spell2_casts ELSE 0 END)",
    "cspm": "CAST((cs * 1200 + game_duration) // nullif(2 * game_duration, 0) AS DOUBLE) / 10",
    "dpm": "dmg_total // nullif(game_duration, 0)",
    "gpm": "gold_earned // nullif(game_duration, 0)",
    "undying_ratio": "time_dead // nullif(game_duration, 0)",
}
METRICS = [name for name, _ in TEMPLATES]
AGG = {name: "min" if name == "undying_ratio" else "max" for name in METRICS}


def _typed(name: str) -> str:
    kind = {"first_blood_kill": "BOOLEAN", "cspm": "DOUBLE", "immortal": "INTEGER"}.get(
        name, "BIGINT"
    )
    return f"CAST({METRIC_SQL.get(name, name)} AS {kind}) AS {name}"


EVENTS_K = """
    g AS (
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(ts AS DATE) AS day
        FROM events
    )"""


def _records(
    source: str, metrics: dict[str, str], player: str, match: str, champion: str, today: str, first: str, last: str
) -> str:
    """CTEs giving ``found``: one row per player with records, over CTE ``source``."""
    history = ", ".join(f"{agg}({m}) AS {m}" for m, agg in metrics.items())
    parts = [
        f"today AS (SELECT * FROM {source} WHERE day = DATE '{today}')",
        f"history AS (SELECT {player} AS player, {history} FROM {source} "
        f"WHERE day BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY 1)",
    ]
    selected, joins = [], []
    for m, agg in metrics.items():
        direction = "DESC" if agg == "max" else "ASC"
        better = ">" if agg == "max" else "<"
        parts.append(
            f"best_{m} AS (SELECT {player} AS player, {m} AS v, "
            f"{match} || '-_-' || {champion} AS meta FROM today WHERE {m} IS NOT NULL "
            f"QUALIFY row_number() OVER (PARTITION BY {player} "
            f"ORDER BY {m} {direction}, {match}, {champion}) = 1)"
        )
        beaten = f"best_{m}.v {better} h.{m}"
        selected.append(f"CASE WHEN {beaten} THEN best_{m}.v END AS {m}")
        selected.append(f"CASE WHEN {beaten} THEN best_{m}.meta END AS {m}_meta")
        joins.append(f"LEFT JOIN best_{m} ON best_{m}.player = h.player")
    parts.append(
        f"found AS (SELECT h.player, {', '.join(selected)} FROM history h {' '.join(joins)})"
    )
    return ",\n".join(parts)


def _event_records(
    metrics: dict[str, str], today="2024-01-30", first="2023-12-30", last="2024-01-29"
) -> str:
    ctes = _records("g", metrics, "user_id", "event_id", "event_type", today, first, last)
    columns = ", ".join(f"{m}, {m}_meta" for m in metrics)
    return f"""WITH {EVENTS_K}, {ctes}
        SELECT c_custkey AS roster_ord, c_custkey AS source_nickname, {columns}
        FROM customer LEFT JOIN found ON player = c_custkey"""


def _ten_days() -> str:
    """The records of ten successive days over the seven days before each."""
    parts = []
    for as_of in range(22, 32):
        days = [f"2024-01-{as_of - n:02d}" for n in (1, 8, 2)]
        rows = _event_records({"value": "max", "k": "min"}, *days)
        parts.append(f"SELECT DATE '2024-01-{as_of}' AS as_of, * FROM ({rows})")
    return " UNION ALL ".join(parts)


GAMES = (
    sql_raw()
    + ", games AS (SELECT source_nickname, match_id, champion_name, game_creation_ts, game_day AS day, "
    + ", ".join(_typed(m) for m in METRICS)
    + " FROM raw)"
)

MATCH_RECORDS = (
    "WITH "
    + GAMES
    + ", "
    + _records(
        "games", AGG, "source_nickname", "match_id", "champion_name",
        "2024-01-30", "2023-12-30", "2024-01-29",
    )
    + ", records AS (SELECT c_custkey AS roster_ord, 'User' || c_custkey || '#T1' AS source_nickname, "
    + ", ".join(f"{m}, {m}_meta" for m in METRICS)
    + " FROM customer LEFT JOIN found ON player = 'User' || c_custkey || '#T1')"
)


def _shown(metric: str) -> str:
    """Message value of a metric; empty values give NULL."""
    if metric == "first_blood_kill":
        return f"CASE WHEN {metric} THEN 'True' END"
    text = f"CAST({metric} AS VARCHAR)"
    return f"CASE WHEN {metric} <> 0 THEN {text} END"


LONG = MATCH_RECORDS + ", long AS (" + " UNION ALL ".join(
    f"SELECT roster_ord, source_nickname, {i} AS metric_ord, '{m}' AS metric, "
    f"{_shown(m)} AS value, {m}_meta AS meta FROM records"
    for i, m in enumerate(METRICS, start=1)
) + """), split AS (
    SELECT roster_ord, source_nickname, metric_ord, metric, value,
           split_part(meta, '-_-', 1) AS match_id, split_part(meta, '-_-', 2) AS champion
    FROM long WHERE value IS NOT NULL
)"""

TEMPLATE_ROWS = ", ".join(f"('{m}', '{text}')" for m, text in TEMPLATES)
LINK = MATCH_LINK.split("%s")

EVENT_LINK = f"'{LINK[0]}' || event_id || '{LINK[1]}RU_' || event_id || '{LINK[2]}'"

MESSAGES = LONG + f""", texts(metric, template) AS (VALUES {TEMPLATE_ROWS}),
once AS (
    SELECT * FROM split QUALIFY row_number() OVER (
        PARTITION BY source_nickname, metric, match_id ORDER BY roster_ord, metric_ord) = 1
), capped AS (
    SELECT * FROM once QUALIFY row_number() OVER (
        PARTITION BY champion ORDER BY roster_ord, metric_ord) <= 3
), messages AS (
    SELECT roster_ord, source_nickname, metric_ord, metric, value, match_id, champion,
           replace(replace(replace(replace(template, '{{nickname}}', source_nickname),
               '{{matchId}}', '{LINK[0]}' || regexp_replace(match_id, '^RU_', '') || '{LINK[1]}'
                   || match_id || '{LINK[2]}'),
               '{{champion}}', champion), '{{value}}', value) AS text
    FROM capped JOIN texts USING (metric)
)"""


def _two_digits(value: str) -> str:
    """Mean, half up; by way of nine digits, so that float noise decides no tie."""
    return f"CAST(round(CAST(round(avg({value}), 9) AS DECIMAL(30, 9)), 2) AS DOUBLE)"


WEEKLY_RATIO = f"""WITH {EVENTS_K}
    SELECT user_id AS source_nickname, CAST(date_trunc('week', day) AS DATE) AS week_start,
           {_two_digits("value / greatest(k, 1)")} AS avg_ratio
    FROM g WHERE day < DATE '2024-01-29' AND day >= DATE '2023-12-25'
      AND user_id IN (SELECT c_custkey FROM customer)
    GROUP BY 1, 2"""


def _weekly_kda(ratio: str) -> str:
    return f"""WITH {sql_raw()}
    SELECT source_nickname, CAST(date_trunc('week', game_day) AS DATE) AS week_start,
           {_two_digits(ratio)} AS avg_kda
    FROM raw WHERE game_day < DATE '2024-01-29' AND game_day >= DATE '2023-12-25'
      AND source_nickname IN (SELECT 'User' || c_custkey || '#T1' FROM customer)
    GROUP BY 1, 2"""


KDA = "(kills + assists) / CASE WHEN deaths IS NOT NULL THEN greatest(deaths, 1) END"
# Tenths per game, half up; then their mean in tenths, half up: whole numbers only.
KDA_TENTHS = "((kills + assists) * 20 + greatest(deaths, 1)) // (2 * greatest(deaths, 1))"
WEEKLY_KDA_DECIMAL = f"""WITH {sql_raw()}, tenths AS (
        SELECT source_nickname, CAST(date_trunc('week', game_day) AS DATE) AS week_start,
               CASE WHEN deaths IS NOT NULL THEN {KDA_TENTHS} END AS t
        FROM raw WHERE game_day < DATE '2024-01-29' AND game_day >= DATE '2023-12-25'
          AND source_nickname IN (SELECT 'User' || c_custkey || '#T1' FROM customer)
    )
    SELECT source_nickname, week_start,
           CAST((2 * sum(t) + count(t)) // (2 * count(t)) AS DOUBLE) / 10 AS avg_kda
    FROM tenths GROUP BY 1, 2"""

PARTICIPANTS = f"""
    both_sides AS (
        SELECT *, 1 AS participant_id FROM raw
        UNION ALL SELECT *, 2 AS participant_id FROM raw
    )"""

DOCUMENT_ROWS = f"""WITH {sql_raw()}, {PARTICIPANTS}
    SELECT match_id, game_creation_ts, CAST(game_duration AS BIGINT) AS game_duration,
           CAST(participant_id AS BIGINT) AS participant_id, champion_name,
           kills + participant_id - 1 AS kills, deaths + participant_id - 1 AS deaths,
           CASE WHEN participant_id = 1 THEN gold_earned END AS gold_earned, source_nickname
    FROM both_sides
    WHERE champion_name NOT IN ('error', 'signup')
      AND NOT (champion_name = 'view' AND match_id IN (
          SELECT 'RU_' || e FROM inputs WHERE k = 50))"""

WEEKLY_KDA_ALL = f"""SELECT source_nickname,
           CAST(date_trunc('week', make_timestamp(game_creation_ts * 1000)) AS DATE) AS week_start,
           {_two_digits("(kills + assists) / CASE WHEN deaths IS NOT NULL THEN greatest(deaths, 1) END")} AS avg_kda
    FROM ({DOCUMENT_ROWS.replace("kills + participant_id", "assists + participant_id - 1 AS assists, kills + participant_id")})
    WHERE make_timestamp(game_creation_ts * 1000) >= TIMESTAMP '2023-12-25'
      AND make_timestamp(game_creation_ts * 1000) < TIMESTAMP '2024-01-29'
      AND source_nickname IN (SELECT 'User' || c_custkey || '#T1' FROM customer)
    GROUP BY 1, 2"""

PART_FILES = """
    files AS (
        SELECT p_brand AS champion, p_partkey AS num,
               p_name || '_' || p_partkey || '.jpg' AS file
        FROM part
    )"""

PICKS = """
    picks AS (
        SELECT lower(regexp_replace(champion, '[\\s_\\-]+', '', 'g')) AS champ_norm, file
        FROM files
        QUALIFY row_number() OVER (PARTITION BY champ_norm ORDER BY
            md5('7|' || champ_norm || '|' || num || '|' || file), num, file) = 1
    )"""


def _plain_number(column: str) -> str:
    return f"regexp_replace(CAST({column} AS VARCHAR), '\\.0$', '')"


def oracle_sql() -> dict[str, str]:
    sql = {
        "record_detect": _event_records({"value": "max", "k": "max"}),
        "record_detect_min": _event_records({"value": "min", "k": "min"}),
        "record_detect_matches": MATCH_RECORDS + " SELECT * FROM records",
        "today_metrics": f"""WITH {EVENTS_K},
            today AS (SELECT * FROM g WHERE day = DATE '2024-01-30'),
            high AS (SELECT * FROM today QUALIFY row_number() OVER (
                PARTITION BY user_id ORDER BY value DESC, event_id) = 1),
            low AS (SELECT * FROM today QUALIFY row_number() OVER (
                PARTITION BY user_id ORDER BY k, event_id) = 1)
            SELECT user_id AS nickname, high.value, high.event_id AS value_match,
                   high.event_type AS value_champion, low.k, low.event_id AS k_match,
                   low.event_type AS k_champion FROM high JOIN low USING (user_id)""",
        "historical_best": f"""WITH {EVENTS_K}
            SELECT user_id AS nickname, max(value) AS hist_value, min(k) AS hist_k FROM g
            WHERE day BETWEEN DATE '2024-01-23' AND DATE '2024-01-29' GROUP BY 1""",
        "own_rows": DOCUMENT_ROWS + " AND participant_id = 1",
        "weekly_avg_kda_all_rows": WEEKLY_KDA_ALL,
        "materialized_weekly": WEEKLY_RATIO,
        "derived_metrics": f"WITH {GAMES} SELECT * EXCLUDE (day) FROM games",
        "derived_metrics_real": f"""WITH {sql_raw()}
            SELECT source_nickname, match_id,
                   round(cs * 60 / nullif(game_duration, 0), 6) AS cspm,
                   round(dmg_total * 60 / nullif(game_duration, 0), 6) AS dpm,
                   round(gold_earned * 60 / nullif(game_duration, 0), 6) AS gpm,
                   round(time_dead * 100 / nullif(game_duration, 0), 6) AS undying_ratio
            FROM raw""",
        "weekly_ratio": WEEKLY_RATIO,
        "weekly_avg_kda": _weekly_kda(KDA),
        "weekly_avg_kda_decimal": WEEKLY_KDA_DECIMAL,
        "roster_semi": """
            SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders
            WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
            GROUP BY 1""",
        "for_player": "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#17'",
        "unpivot_records": LONG + " SELECT * FROM split",
        "build_messages": MESSAGES + " SELECT * FROM messages",
        "number_messages": MESSAGES
        + """ SELECT row_number() OVER (ORDER BY roster_ord, metric_ord) AS pos,
                count(*) OVER () AS total, '(' || pos || '/' || total || ')' AS label,
                source_nickname, metric, text FROM messages""",
        "number_rows": """
            SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos,
                   count(*) OVER () AS total FROM orders""",
        "cap_per_group": """
            SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(row_number() OVER (
                PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
            FROM orders QUALIFY place <= 3""",
        "limit_per_group": """
            SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                ORDER BY o_orderdate DESC, o_orderkey) <= 1""",
        "first_occurrence": f"""WITH {EVENTS_K}
            SELECT user_id, event_type, event_id, k FROM g
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
        "message_text": f"""
            SELECT event_id, 'RU_' || event_id AS match_id, event_type AS champion,
                   {_plain_number("value")} AS value,
                   CASE event_type
                   WHEN 'click' THEN user_id || ': ' || {_plain_number("value")} || ' in ' || {EVENT_LINK}
                       || ' as click (' || {_plain_number("value")} || ')'
                   WHEN 'error' THEN 'error ' || {_plain_number("value")}
                   WHEN 'purchase' THEN user_id || ' paid ' || {_plain_number("value")} || ', see ' || {EVENT_LINK}
                   WHEN 'signup' THEN {EVENT_LINK} || user_id
                   WHEN 'view' THEN 'no values at all' END AS text
            FROM events""",
        "explode_nested": DOCUMENT_ROWS,
        "read_landed_matches": DOCUMENT_ROWS,
        "rejected_matches": f"""WITH {EVENTS_K}
            SELECT event_id, 'User' || user_id || '#T1' AS source_nickname FROM g
            WHERE event_type IN ('error', 'signup') OR (event_type = 'view' AND k = 50)""",
        "distinct_participants": f"""WITH {sql_raw()}
            SELECT match_id, game_creation_ts, CAST(game_duration AS BIGINT) AS game_duration,
                   CAST(1 AS BIGINT) AS participant_id, champion_name, kills, deaths,
                   gold_earned, source_nickname FROM raw""",
        "ingest_grid_missing": """
            WITH grid AS (
                SELECT c_custkey AS roster_ord, CAST(d AS DATE) AS load_date,
                       CAST(c_custkey AS VARCHAR) AS player_key
                FROM customer, generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) AS s(d)
            )
            SELECT * FROM grid WHERE NOT EXISTS (
                SELECT 1 FROM events WHERE CAST(ts AS DATE) = load_date
                AND CAST(user_id AS VARCHAR) = player_key)""",
        "json_map": """
            SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_value,
                   CAST(json_extract_string(props, '$.absent') AS BIGINT) AS absent_value,
                   CAST(len(json_keys(props)) AS BIGINT) AS n_keys,
                   '{"k":' || json_extract_string(props, '$.k') || '}' AS payload
            FROM events""",
        "conform_schema": f"""WITH {EVENTS_K}
            SELECT event_id, value, CAST(CASE WHEN event_type <> 'view' THEN k END AS DOUBLE) AS k,
                   CAST(CASE WHEN event_type <> 'view' THEN 2 ELSE 1 END AS BIGINT) AS n_keys,
                   true AS no_missions, user_id FROM g""",
        "nested_columns": f"""WITH {EVENTS_K}
            SELECT event_id, k AS offense, value AS challenge,
                   CASE WHEN event_type = 'click' THEN k END AS click_mission,
                   user_id AS style, perk
            FROM (SELECT *, event_id AS perk FROM g UNION ALL SELECT *, k AS perk FROM g)""",
        "select_columns": "SELECT o_orderkey, o_totalprice FROM orders",
        "day_bounds": """
            WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS day FROM events)
            SELECT event_id, ms, day, strftime(day, '%Y-%m-%d') AS day_text,
                   CAST(epoch(day) AS BIGINT) AS start_s, CAST(epoch(day) AS BIGINT) + 86400 AS end_s,
                   day = DATE '2024-01-30' AS is_target,
                   day BETWEEN DATE '2023-12-30' AND DATE '2024-01-29' AS in_history FROM e""",
        "week_bounds": """
            SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week_start,
                   CAST(ts AS DATE) < DATE '2024-01-29' AND CAST(ts AS DATE) >= DATE '2023-12-25'
                       AS in_full_weeks FROM events""",
        "number_functions": f"""
            SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
                   CAST(l_quantity AS BIGINT) // nullif(CAST(l_linenumber AS BIGINT) - 1, 0) AS per_line,
                   greatest(CAST(l_linenumber AS BIGINT) - 3, 1) AS at_least_one,
                   CASE WHEN l_linenumber = 4 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS line4_quantity,
                   {_plain_number("l_extendedprice")} AS price_text,
                   l_discount <> 0 AS discounted FROM lineitem""",
        "text_keys": f"""
            SELECT p_partkey, p_name || '#' || p_brand AS plain, p_type LIKE '%#%' AS type_is_id,
                   replace(p_name || '#' || p_brand, '#', '_') AS path_key,
                   p_name AS name, p_brand AS tag, CAST(NULL AS VARCHAR) AS no_tag,
                   replace(replace(p_name || '#' || p_brand, '#', '%23'), ' ', '%20') AS encoded,
                   lower(regexp_replace(p_name, '[\\s_\\-]+', '', 'g')) AS name_key,
                   'stage/2024-01-30/' || replace(p_name || '#' || p_brand, '#', '_') AS path,
                   p_brand NOT LIKE '%#%' AS own,
                   '{PLAYER_LINK[:-2]}' || replace(replace(p_name || '#' || p_brand, '#', '%23'), ' ', '%20') AS link
            FROM part""",
        "manifest_files": f"""WITH {PART_FILES}
            SELECT champion, num // 1000 AS chunk,
                   CAST(to_json(list(file ORDER BY num)) AS VARCHAR) AS files
            FROM files GROUP BY 1, 2""",
        "manifest_rows": f"""WITH {PART_FILES}
            SELECT champion, lower(regexp_replace(champion, '[\\s_\\-]+', '', 'g')) AS champ_norm,
                   '/splashes/' || file AS file FROM files""",
        "skin_files": """
            SELECT p_brand AS champion, CAST(p_partkey AS INTEGER) AS num,
                   p_brand || '_' || p_partkey || '.jpg' AS file FROM part
            UNION ALL
            SELECT p_brand, p_size, p_brand || '_' || p_size || '.jpg' FROM part""",
        "pick_random": f"WITH {PART_FILES}, {PICKS} SELECT champ_norm, file FROM picks",
        "directory_manifest": f"""WITH {PART_FILES}
            SELECT p_name AS champion, lower(regexp_replace(p_name, '[\\s_\\-]+', '', 'g')) AS champ_norm,
                   file FROM files JOIN part ON p_partkey = num""",
        "manifest_join": f"""WITH {PART_FILES}, {PICKS}
            SELECT lower(regexp_replace(p_brand, '[\\s_\\-]+', '', 'g')) AS champ_norm, p_partkey, p_brand,
                   CASE WHEN p_brand NOT IN ('Brand#1', 'Brand#2') THEN file END AS file
            FROM part LEFT JOIN picks ON champ_norm = lower(regexp_replace(p_brand, '[\\s_\\-]+', '', 'g'))""",
        "prune_unlisted": """
            SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "partition_roundtrip": """
            SELECT event_id, event_type, value, CAST(user_id AS VARCHAR) AS player_key,
                   CAST(ts AS DATE) AS load_date FROM events""",
        "list_partitions": """
            SELECT DISTINCT CAST(ts AS DATE) AS load_date, CAST(user_id AS VARCHAR) AS player_key
            FROM events""",
        "concat_records": _concat_records(),
    }
    sql["snapshot_roundtrip"] = sql["record_detect"]
    sql["stream_refresh"] = sql["record_detect"]
    sql["record_detect_incremental"] = _ten_days()
    sql["stream_ingest"] = DOCUMENT_ROWS
    # One step for each kept row: the first one behind it that the rows kept so far allow.
    sql["cap_in_order"] = f"""WITH RECURSIVE {EVENTS_K},
        listed AS (
            SELECT user_id AS source_nickname, 'value' AS metric, k AS match_id,
                   event_type || '_' || hour(ts) AS champion, event_id,
                   user_id || '/' || k AS key
            FROM g
        ),
        steps AS (
            SELECT CAST(-1 AS BIGINT) AS event_id, CAST([] AS VARCHAR[]) AS champions,
                   CAST([] AS VARCHAR[]) AS keys
            UNION ALL
            SELECT n.event_id, list_append(champions, n.champion), list_append(keys, n.key)
            FROM (
                SELECT arg_min(listed, listed.event_id) AS n, any_value(champions) AS champions,
                       any_value(keys) AS keys
                FROM steps JOIN listed ON listed.event_id > steps.event_id
                    AND NOT list_contains(keys, key)
                    AND len(list_filter(champions, lambda c: c = champion)) < 3
            ) WHERE n IS NOT NULL
        )
        SELECT source_nickname, metric, match_id, champion, event_id
        FROM listed JOIN steps USING (event_id)"""
    sql["materialized_view"] = WEEKLY_RATIO
    sql["ordered_weeks"] = f"""
        SELECT *, row_number() OVER (ORDER BY week_start DESC, source_nickname) AS pos,
               count(*) OVER () AS total FROM ({WEEKLY_RATIO})"""
    sql["ordered_messages"] = MESSAGES + """
        SELECT row_number() OVER (ORDER BY roster_ord, metric_ord) AS pos,
               source_nickname, metric, text FROM messages"""
    sql["participant_table"] = DOCUMENT_ROWS
    sql["snapshot_counts"] = """
        SELECT CAST(1 AS BIGINT) AS seq, count(*) AS written_rows FROM events
        UNION ALL SELECT 2, count(*) FROM orders"""
    # Steps 2 and 3 see what step 1 and step 3 stored; step 1 still gets the old rows.
    sql["snapshot_branches"] = """
        SELECT CAST(step AS INTEGER) AS step, event_id
        FROM (VALUES (0, 1), (1, 1), (2, 2), (3, 4), (4, 5)) AS served(step, every), events
        WHERE event_id % every = 0"""
    sql["stream_restart"] = "SELECT event_id, event_id % 2 AS batch_id FROM events"
    sql["drifted_documents"] = (
        f"SELECT * FROM ({DOCUMENT_ROWS}) WHERE CAST(substr(match_id, 4) AS BIGINT) % 5 <> 3"
    )
    sql["daily_late_matches"] = DOCUMENT_ROWS
    sql["stream_ingest_repeats"] = DOCUMENT_ROWS
    sql["stream_dedupe"] = "SELECT event_id, props FROM events"
    # Only documents that are complete get into the table.
    complete = (
        "        FROM events\n    ),\n    raw AS",
        """        FROM events
        WHERE event_type NOT IN ('error', 'signup') AND NOT (
            event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS BIGINT) = 50)
    ),
    raw AS""",
    )
    sql["daily_window_records"] = MATCH_RECORDS.replace(*complete) + " SELECT * FROM records"
    sql["daily_messages"] = MESSAGES.replace(*complete) + (
        " SELECT * EXCLUDE (roster_ord, metric_ord),"
        " CASE WHEN champion <> 'view' THEN champion || '.jpg' END AS file FROM messages"
    )
    return sql


def _concat_records() -> str:
    models = [
        ("events", "customer", "c_custkey", "user_id", "event_id", "event_type", "ts", "value",
         "2024-01-30", "2023-12-30", "2024-01-29"),
        ("orders", "customer", "c_custkey", "o_custkey", "o_orderkey", "o_orderpriority",
         "o_orderdate", "o_totalprice", "2001-06-30", "2001-05-30", "2001-06-29"),
        ("lineitem", "supplier", "s_suppkey", "l_suppkey", "l_orderkey", "l_returnflag",
         "l_shipdate", "l_extendedprice", "2001-06-30", "2001-05-30", "2001-06-29"),
    ]
    branches = []
    for name, roster, key, player, match, champion, time, measure, today, first, last in models:
        ctes = _records("g", {"best": "max"}, "player", "match", "champion", today, first, last)
        branches.append(
            f"""SELECT * FROM (WITH g AS (
                    SELECT {player} AS player, {match} AS match, {champion} AS champion,
                           CAST({time} AS DATE) AS day, {measure} AS best FROM {name}), {ctes}
                SELECT best, best_meta, {key} AS source_nickname, '{name}' AS model
                FROM {roster} LEFT JOIN found ON player = {key})"""
        )
    return " UNION ALL ".join(branches)
