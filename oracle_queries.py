"""DuckDB SQL with the same result as each registered query, over the same tables.

The common tables below mirror the adapter and the fact grains; each query adds its own
last step.  Sums go through DECIMAL on both sides so that order cannot change them.
"""

EV = """
ev AS (
  SELECT *,
    CAST(timestamp AS DATE) AS event_date,
    timestamp + to_milliseconds(k * 37) AS ingestion_timestamp
  FROM (
    SELECT
      event_id AS n,
      'ev_' || CAST(event_id AS VARCHAR) AS event_id,
      CASE event_type
        WHEN 'purchase' THEN 'combat_damage' WHEN 'click' THEN 'heal'
        WHEN 'view' THEN 'spell_cast' WHEN 'signup' THEN 'mana_regeneration'
        ELSE CASE WHEN k < 50 THEN 'player_death' ELSE 'boss_phase' END END AS event_type,
      ts AS timestamp,
      'raid' || lpad(CAST(day(ts) AS VARCHAR), 3, '0') AS raid_id,
      CASE WHEN event_type = 'error' THEN 'boss_' || CAST(day(ts) AS VARCHAR)
        ELSE 'player_' || lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') END AS source_player_id,
      CASE WHEN event_type = 'error' THEN 'Boss'
        ELSE 'P' || lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') END AS source_player_name,
      CASE WHEN event_type = 'error' THEN NULL WHEN (user_id % 25) % 10 = 0 THEN 'tank'
        WHEN (user_id % 25) % 10 IN (1, 2) THEN 'healer' ELSE 'dps' END AS source_player_role,
      CASE WHEN event_type <> 'error' THEN
        ['warrior','paladin','hunter','rogue','priest','shaman','mage','warlock','druid',
         'death_knight','monk'][CAST((user_id % 25) % 11 AS INT) + 1] END AS source_player_class,
      CASE WHEN event_type = 'purchase' THEN value * 300 END AS damage_amount,
      CASE WHEN event_type = 'click' THEN value * 190 END AS healing_amount,
      event_type IN ('purchase', 'click') AND k % 6 = 0 AS is_critical_hit,
      CASE WHEN event_type IN ('purchase', 'view') OR (event_type = 'error' AND k >= 50)
        THEN 'boss' ELSE 'player' END AS target_entity_type,
      CASE WHEN event_type IN ('purchase', 'view') OR (event_type = 'error' AND k >= 50)
        THEN 'boss_' || CAST(day(ts) AS VARCHAR)
        ELSE 'player_' || lpad(CAST((user_id + k) % 25 AS VARCHAR), 3, '0') END AS target_entity_id,
      CASE WHEN event_type IN ('purchase', 'click', 'error')
        THEN CAST(k AS DOUBLE) * CAST(1.1 AS DOUBLE) - 4 END AS target_entity_health_pct_before,
      CASE WHEN event_type IN ('purchase', 'click') OR (event_type = 'error' AND k >= 50)
        THEN CAST(k AS DOUBLE)
        WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) END AS target_entity_health_pct_after,
      CAST(20 + k % 60 AS BIGINT) AS server_latency_ms,
      CASE WHEN event_type = 'signup' THEN 'mana' END AS resource_type,
      'b' || printf('%09d', event_id // 500) AS batch_id,
      event_id % 500 AS idx,
      k
    FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k FROM events)
  )
),
twice AS (
  SELECT * FROM ev
  UNION ALL
  SELECT * REPLACE (ingestion_timestamp + INTERVAL 1 HOUR AS ingestion_timestamp,
                    'again_' || batch_id AS batch_id) FROM ev
)"""


def money(expression: str) -> str:
    return f"coalesce(CAST(sum(CAST({expression} AS DECIMAL(20,4))) AS DOUBLE), 0.0::DOUBLE)"


def div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0::DOUBLE)"


def pct(a: str, b: str) -> str:
    return f"({div(a, b)} * 100.0::DOUBLE)"


MILLIS = "CAST(epoch_us(max(timestamp)) - epoch_us(min(timestamp)) AS DOUBLE) / 1000.0::DOUBLE"


def summary(name: str, players: str, limit: int = 360000) -> str:
    """Raid facts; ``players`` is the condition that makes a source a participant."""
    return f"""
{name} AS (
  SELECT s.raid_id, event_date, duration_ms, total_damage, total_healing,
    total_player_deaths, n_players, n_tanks, n_healers, n_dps,
    {div('total_damage', 'duration_ms / 1000.0::DOUBLE')} AS raid_dps,
    {div('total_healing', 'duration_ms / 1000.0::DOUBLE')} AS raid_hps,
    boss_min_hp_pct,
    CASE WHEN (boss_min_hp_pct = 0 AND duration_ms <= {limit})
      OR (boss_min_hp_pct < 10 AND total_player_deaths <= n_players)
      THEN 'success' ELSE 'wipe' END AS raid_outcome
  FROM (
    SELECT raid_id, min(event_date) AS event_date, {MILLIS} AS duration_ms,
      {money("CASE WHEN event_type = 'combat_damage' THEN damage_amount END")} AS total_damage,
      {money("CASE WHEN event_type = 'heal' THEN healing_amount END")} AS total_healing,
      count(DISTINCT source_player_id) AS n_players,
      count(DISTINCT source_player_id) FILTER (source_player_role = 'tank') AS n_tanks,
      count(DISTINCT source_player_id) FILTER (source_player_role = 'healer') AS n_healers,
      count(DISTINCT source_player_id) FILTER (source_player_role = 'dps') AS n_dps,
      coalesce(min(target_entity_health_pct_after) FILTER (target_entity_type = 'boss'),
        100.0::DOUBLE) AS boss_min_hp_pct
    FROM ev WHERE {players} GROUP BY raid_id) s
  JOIN (SELECT raid_id, count(*) FILTER (event_type = 'player_death') AS total_player_deaths
    FROM ev GROUP BY raid_id) d ON s.raid_id = d.raid_id
)"""


def stats(name: str, summ: str, players: str, victim: str = "source") -> str:
    deaths = "deaths" if victim == "source" else "coalesce(deaths_as_target, 0)"
    return f"""
{name}_received AS (
  SELECT raid_id, target_entity_id AS player_id,
    {money(f"CASE WHEN event_type = 'combat_damage' AND ({players}) THEN damage_amount END")}
      AS total_damage_received,
    count(*) FILTER (event_type = 'player_death') AS deaths_as_target
  FROM ev WHERE event_type IN ('combat_damage', 'player_death') GROUP BY ALL
),
{name} AS (
  SELECT p.raid_id, s.event_date, p.player_id, player_name, player_class, player_role,
    damage_total, healing_total, damage_events, healing_events,
    {deaths} AS player_deaths, crit_events,
    {div('crit_events', 'damage_events + healing_events')} AS crit_rate,
    coalesce(total_damage_received, 0.0::DOUBLE) AS total_damage_received,
    {div('damage_total', 'duration_ms / 1000.0::DOUBLE')} AS dps,
    {div('healing_total', 'duration_ms / 1000.0::DOUBLE')} AS hps,
    {div('damage_total', 'total_damage')} AS damage_share,
    {div('healing_total', 'total_healing')} AS healing_share
  FROM (
    SELECT raid_id, source_player_id AS player_id,
      arg_min(source_player_name, timestamp) AS player_name,
      arg_min(source_player_class, timestamp) AS player_class,
      arg_min(source_player_role, timestamp) AS player_role,
      {money("CASE WHEN event_type = 'combat_damage' THEN damage_amount END")} AS damage_total,
      {money("CASE WHEN event_type = 'heal' THEN healing_amount END")} AS healing_total,
      count(*) FILTER (event_type = 'combat_damage') AS damage_events,
      count(*) FILTER (event_type = 'heal') AS healing_events,
      count(*) FILTER (event_type = 'player_death') AS deaths,
      count(*) FILTER (event_type IN ('combat_damage', 'heal') AND is_critical_hit) AS crit_events
    FROM ev WHERE {players} GROUP BY ALL) p
  LEFT JOIN {name}_received r ON p.raid_id = r.raid_id AND p.player_id = r.player_id
  LEFT JOIN {summ} s ON p.raid_id = s.raid_id
)"""


PLAYERS = "starts_with(source_player_id, 'player_')"
SUMM = summary("summ", PLAYERS)
STATS = stats("stats", "summ", PLAYERS)
SUMM_ALL = summary("summ_all", "true")
STATS_ALL = stats("stats_all", "summ_all", "true")


def dim_players(name: str, where: str = "true", players: str = PLAYERS) -> str:
    return f"""
{name} AS (
  SELECT source_player_id AS player_id,
    arg_min(source_player_name, timestamp) AS player_name,
    coalesce(arg_min(source_player_class, timestamp), 'unknown') AS player_class,
    coalesce(arg_min(source_player_role, timestamp), 'unknown') AS player_role,
    min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
    count(DISTINCT raid_id) AS total_raids
  FROM ev WHERE ({players}) AND ({where}) GROUP BY source_player_id
)"""


def dim_raids(
    name: str, where: str = "true", boss: str = "Unknown Boss", difficulty: str = "Normal"
) -> str:
    return f"""
{name} AS (
  SELECT raid_id, min(event_date) AS event_date, '{boss}' AS boss_name,
    '{difficulty}' AS difficulty, count(DISTINCT source_player_id) AS raid_size,
    360000.0::DOUBLE AS duration_target_ms
  FROM ev WHERE {where} GROUP BY raid_id
)"""


FIRST = "event_date < DATE '2024-01-16'"
SECOND = "event_date >= DATE '2024-01-16'"
TWO_LOADS = dim_players("one", FIRST) + "," + dim_players("two", SECOND)


def q(last: str, *tables: str) -> str:
    return "WITH " + ",".join((EV, *tables)) + "\n" + last


BAD_HEALTH = """(coalesce(target_entity_health_pct_before < 0 OR
  target_entity_health_pct_before > 100, false))"""
BAD_AFTER = """(coalesce(target_entity_health_pct_after < 0 OR
  target_entity_health_pct_after > 100, false))"""
KEPT = "event_id, event_type, raid_id, source_player_id, damage_amount, batch_id"
AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"

# Broken event rules in the order of the rule set, as (rule, column, condition).
EVENT_RULES = (
    ("domain", "event_type", "false"),
    ("range", "damage_amount", "damage_amount < 0 OR damage_amount > 1000000"),
    ("range", "healing_amount", "healing_amount < 0 OR healing_amount > 500000"),
    ("range", "target_entity_health_pct_before",
     "target_entity_health_pct_before < 0 OR target_entity_health_pct_before > 100"),
    ("range", "target_entity_health_pct_after",
     "target_entity_health_pct_after < 0 OR target_entity_health_pct_after > 100"),
    ("future", "timestamp", f"timestamp > {AS_OF}"),
    ("conditional", "damage_amount",
     "event_type = 'combat_damage' AND (damage_amount IS NULL OR damage_amount <= 0)"),
    ("conditional", "healing_amount",
     "event_type = 'heal' AND (healing_amount IS NULL OR healing_amount <= 0)"),
    ("conditional", "resource_type", "event_type = 'mana_regeneration' AND resource_type IS NULL"),
)
UUID_RULE = (
    "pattern", "event_id",
    "NOT regexp_matches(event_id, '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$')",
)
BROKEN_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {cond} THEN '{rule}:{column}' END" for rule, column, cond in EVENT_RULES
) + ")"
MARKED = f"""
marked AS (
  SELECT *, {BROKEN_LIST} AS broken,
    'b' || printf('%09d', n // 10) AS small_batch, n % 10 AS small_idx FROM ev
),
verdict AS (
  SELECT small_batch AS batch_id, count(*) AS event_count,
    count(*) FILTER (broken = '') AS valid_count,
    count(*) FILTER (broken <> '') AS invalid_count,
    count(DISTINCT raid_id) AS raid_count
  FROM marked GROUP BY small_batch
),
judged AS (
  SELECT *, CASE WHEN invalid_count > 0 OR raid_count > 1 THEN 'rejected' ELSE 'accepted' END
      AS status,
    concat_ws(',', CASE WHEN invalid_count > 0 THEN 'invalid_events' END,
      CASE WHEN event_count > 10000 THEN 'too_many_events' END,
      CASE WHEN raid_count > 1 THEN 'mixed_raids' END) AS reasons
  FROM verdict
)"""


def counted_rules(table: str, source: str, rules, prefix_columns: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {prefix_columns}'{rule}' AS rule, '{column}' AS \"column\", "
        f"count(*) AS broken_rows FROM {source} WHERE {cond} HAVING count(*) > 0"
        for rule, column, cond in rules
    )


def top(measure: str, extra: str, where: str = "true", source: str = "stats") -> str:
    more = f", {extra}" if extra else ""
    return f"""SELECT raid_id, place, player_id, player_name, player_class, player_role,
      {measure}{more} FROM (
      SELECT *, row_number() OVER (PARTITION BY raid_id ORDER BY {measure} DESC, player_id) AS place
      FROM {source} WHERE {where}) WHERE place <= 3"""


AVERAGES = """
averages AS (
  SELECT player_id, player_name, player_class, player_role,
    CAST(sum(CAST(dps AS DECIMAL(20,6))) AS DOUBLE) / CAST(count(dps) AS DOUBLE) AS avg_dps,
    CAST(sum(CAST(hps AS DECIMAL(20,6))) AS DOUBLE) / CAST(count(hps) AS DOUBLE) AS avg_hps,
    count(dps) AS raids
  FROM stats GROUP BY ALL
)"""
TYPES = ("combat_damage", "heal", "player_death", "spell_cast", "boss_phase", "mana_regeneration")

HP = 500000
TIMELINE = f"""
hits AS (
  SELECT raid_id, event_id, timestamp, target_entity_id, damage_amount,
    row_number() OVER w AS hit,
    sum(CAST(damage_amount AS DECIMAL(20,6))) OVER w AS dealt
  FROM ev WHERE event_type = 'combat_damage' AND damage_amount <> 0
  WINDOW w AS (PARTITION BY raid_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)
),
health AS (
  SELECT *,
    CAST(greatest(0, {HP} - (dealt - CAST(damage_amount AS DECIMAL(20,6)))) AS DOUBLE)
      / {HP}::DOUBLE * 100.0::DOUBLE AS hp_pct_before,
    CAST(greatest(0, {HP} - dealt) AS DOUBLE) / {HP}::DOUBLE * 100.0::DOUBLE AS hp_pct_after
  FROM hits
),
crossed AS (
  SELECT raid_id, min(hit) FILTER (hp_pct_after <= 70) AS c1,
    min(hit) FILTER (hp_pct_after <= 40) AS c2 FROM health GROUP BY raid_id
),
line AS (
  SELECT h.*,
    CAST(1 + CASE WHEN hit >= c1 THEN 1 ELSE 0 END
           + CASE WHEN hit >= greatest(c2, c1 + 1) AND c2 IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS phase,
    coalesce(hit = c1, false) OR coalesce(c2 IS NOT NULL AND hit = greatest(c2, c1 + 1), false)
      AS is_transition
  FROM health h JOIN crossed c ON h.raid_id = c.raid_id
)"""

IMPACT = """
scored AS (
  SELECT raid_id, event_date, player_id, player_name,
    CAST(round(CAST(greatest(0.0::DOUBLE, least(100.0::DOUBLE,
      0.35::DOUBLE * (damage_share * 100.0::DOUBLE) + 0.35::DOUBLE * (healing_share * 100.0::DOUBLE)
      + 0.15::DOUBLE * (crit_rate * 100.0::DOUBLE)
      + (-0.10)::DOUBLE * (player_deaths * 10.0::DOUBLE))) AS DECIMAL(38,12)), 6) AS DOUBLE)
      AS impact_score
  FROM stats
)"""

CLASS_ROLES = "(VALUES " + ", ".join(
    f"('{c}', '{r}')"
    for c, roles in {
        "death_knight": "tank dps", "druid": "dps tank healer", "hunter": "dps", "mage": "dps",
        "monk": "tank healer dps", "paladin": "healer tank dps", "priest": "healer dps",
        "rogue": "dps", "shaman": "dps healer", "warlock": "dps", "warrior": "dps tank",
    }.items()
    for r in roles.split()
) + ") AS known(c, r)"

DISORDER = """
disorder AS (
  SELECT raid_id, count(*) AS events, count(*) - count(DISTINCT event_id) AS repeated_ids,
    count(*) FILTER (timestamp < previous) AS out_of_order
  FROM (SELECT *, lag(timestamp) OVER (PARTITION BY raid_id
          ORDER BY ingestion_timestamp, event_id, batch_id) AS previous FROM {source})
  GROUP BY raid_id
)"""
MD5_ID = "md5(event_id || chr(1) || raid_id)"
SHARE_STATUS = (
    "CASE WHEN sum({0}) = 0 THEN 'warn' WHEN abs(sum({0}) - 1) < 0.01 THEN 'ok' ELSE 'fail' END"
)

REFINED = f"refined AS (SELECT * FROM ev WHERE NOT {BAD_HEALTH} AND NOT {BAD_AFTER})"
MASSIVE = "coalesce(event_type = 'combat_damage' AND damage_amount > 10000, false)"
LATENCY = "date_sub('millisecond', timestamp, ingestion_timestamp)"

ORACLES = {
    "raid_summary": q("SELECT * FROM summ", SUMM),
    "raid_outcome": q(
        "SELECT raid_id, boss_min_hp_pct, total_player_deaths, n_players, raid_outcome FROM summ",
        summary("summ", PLAYERS, 86000000)),
    "role_composition": q("SELECT raid_id, n_players, n_tanks, n_healers, n_dps FROM summ", SUMM),
    "player_raid_stats": q("SELECT * FROM stats", SUMM, STATS),
    "player_raid_stats_by_victim": q(
        "SELECT * FROM stats", SUMM, stats("stats", "summ", PLAYERS, "target")),
    "damage_received": q("SELECT * FROM stats_all_received", SUMM_ALL, STATS_ALL),
    "raid_fact_lean": q(f"""
      SELECT raid_id, count(event_id) AS total_events,
        count(DISTINCT source_player_id) AS n_players,
        CAST(round(sum(CAST(damage_amount AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_damage,
        CAST(round(sum(CAST(healing_amount AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_healing,
        CAST(round(CAST(CAST(sum(CAST(damage_amount AS DECIMAL(20,4))) AS DOUBLE)
          / count(damage_amount) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_damage_per_event,
        CAST(sum(CAST(is_critical_hit AS INT)) AS BIGINT) AS n_critical_hits,
        CAST(round(CAST(({MILLIS}) / 1000.0::DOUBLE AS DECIMAL(38,10)), 2) AS DOUBLE)
          AS raid_duration_s,
        CAST(round(CAST(avg(server_latency_ms) AS DECIMAL(38,10)), 2) AS DOUBLE)
          AS avg_server_latency_ms
      FROM ev GROUP BY raid_id"""),
    "player_fact_lean": q(f"""
      SELECT source_player_id, raid_id, arg_min(source_player_name, timestamp) AS player_name,
        arg_min(source_player_class, timestamp) AS player_class,
        arg_min(source_player_role, timestamp) AS player_role,
        count(event_id) AS total_events,
        CAST(round(sum(CAST(damage_amount AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_damage,
        CAST(round(sum(CAST(healing_amount AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_healing,
        CAST(round(CAST(CAST(sum(CAST(damage_amount AS DECIMAL(20,4))) AS DOUBLE)
          / nullif(count(damage_amount), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_damage,
        CAST(sum(CAST(is_critical_hit AS INT)) AS BIGINT) AS n_critical_hits,
        CAST(round(CAST(CAST(sum(CAST(is_critical_hit AS INT)) AS DOUBLE) * 100
          / count(event_id) AS DECIMAL(38,10)), 2) AS DOUBLE) AS critical_hit_rate_pct
      FROM ev WHERE {PLAYERS} GROUP BY source_player_id, raid_id"""),
    "dim_player": q("SELECT * FROM dim", dim_players("dim")),
    "dim_raid": q("SELECT * FROM dim", dim_raids("dim")),
    "dim_raid_dated": q("SELECT * FROM dim", dim_raids("dim")),
    "player_stats_labelled": q(
        """SELECT raid_id, player_id, coalesce(player_class, 'unknown') AS player_class,
          coalesce(player_role, 'unknown') AS player_role, player_deaths FROM stats_all""",
        SUMM_ALL, STATS_ALL),
    "unlabelled_players": q(
        """SELECT count(*) FILTER (player_class IS NULL) AS null_player_class,
          count(*) FILTER (player_role IS NULL) AS null_player_role FROM stats_all""",
        SUMM_ALL, STATS_ALL),
    "impact_index": q(
        """SELECT raid_id, event_date, player_id, player_name, impact_score,
          row_number() OVER (PARTITION BY raid_id ORDER BY impact_score DESC, player_id)
            AS impact_rank,
          CASE WHEN impact_score >= 80 THEN 'core' WHEN impact_score >= 60 THEN 'solid'
            WHEN impact_score >= 40 THEN 'average' ELSE 'low' END AS impact_band,
          'unknown' AS style_cluster FROM scored""", SUMM, STATS, IMPACT),
    "consolidated_view": q(
        """SELECT s.raid_id, s.event_date, 'Unknown Boss' AS boss_name,
          'Normal' AS difficulty, raid_outcome, total_damage, total_healing, raid_dps, raid_hps,
          total_player_deaths,
          CAST(n_players AS VARCHAR) || '/' || CAST(n_players AS VARCHAR) AS players,
          boss_min_hp_pct, true AS fk_raid_ok, true AS raid_size_ok,
          abs(share - 1.0) < 0.01 AS damage_share_ok, abs(share - 1.0) < 0.01 AS coherence_ok
        FROM summ s JOIN (SELECT raid_id, sum(damage_share) AS share FROM stats GROUP BY raid_id) x
          ON s.raid_id = x.raid_id""", SUMM, STATS),
    "dim_player_upsert_merge": q(
        """SELECT coalesce(two.player_id, one.player_id) AS player_id,
          coalesce(two.player_name, one.player_name) AS player_name,
          coalesce(two.player_class, one.player_class) AS player_class,
          coalesce(two.player_role, one.player_role) AS player_role,
          coalesce(one.first_seen_date, two.first_seen_date) AS first_seen_date,
          coalesce(two.last_seen_date, one.last_seen_date) AS last_seen_date,
          coalesce(two.total_raids, one.total_raids) AS total_raids
        FROM one FULL JOIN two ON one.player_id = two.player_id""", TWO_LOADS),
    "dim_player_upsert_min": q(
        """SELECT coalesce(one.player_id, two.player_id) AS player_id,
          coalesce(one.player_name, two.player_name) AS player_name,
          coalesce(one.player_class, two.player_class) AS player_class,
          coalesce(one.player_role, two.player_role) AS player_role,
          least(one.first_seen_date, two.first_seen_date) AS first_seen_date,
          coalesce(one.last_seen_date, two.last_seen_date) AS last_seen_date,
          coalesce(one.total_raids, two.total_raids) AS total_raids
        FROM one FULL JOIN two ON one.player_id = two.player_id""", TWO_LOADS),
    "dim_player_upsert_additive": q(
        """SELECT coalesce(one.player_id, two.player_id) AS player_id,
          coalesce(one.player_name, two.player_name) AS player_name,
          coalesce(one.player_class, two.player_class) AS player_class,
          coalesce(one.player_role, two.player_role) AS player_role,
          least(one.first_seen_date, two.first_seen_date) AS first_seen_date,
          greatest(one.last_seen_date, two.last_seen_date) AS last_seen_date,
          coalesce(one.total_raids, 0) + coalesce(two.total_raids, 0) AS total_raids
        FROM one FULL JOIN two ON one.player_id = two.player_id""", TWO_LOADS),
    "dim_raid_upsert": q(
        """SELECT n.raid_id, coalesce(o.event_date, n.event_date) AS event_date, n.boss_name,
          n.difficulty, n.raid_size, n.duration_target_ms
        FROM newer n LEFT JOIN older o ON n.raid_id = o.raid_id""",
        dim_raids("older", FIRST), dim_raids("newer", PLAYERS, "Named Boss", "Heroic")),
    "dim_player_versions": q(
        """SELECT *, 1::BIGINT AS version FROM one UNION ALL
        SELECT coalesce(two.player_id, one.player_id),
          coalesce(two.player_name, one.player_name), coalesce(two.player_class, one.player_class),
          coalesce(two.player_role, one.player_role),
          coalesce(one.first_seen_date, two.first_seen_date),
          coalesce(two.last_seen_date, one.last_seen_date),
          coalesce(two.total_raids, one.total_raids), 2::BIGINT
        FROM one FULL JOIN two ON one.player_id = two.player_id""", TWO_LOADS),
    "dim_player_history": q(
        """SELECT 1::BIGINT AS version, 'create' AS operation, count(*) AS rows FROM one
        UNION ALL SELECT 2::BIGINT, 'upsert', count(*) FROM one FULL JOIN two
          ON one.player_id = two.player_id""", TWO_LOADS),
    "silver_dedup": q(f"""SELECT {KEPT}, ingestion_timestamp FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp, batch_id)
          AS rn FROM twice) WHERE rn = 1"""),
    "silver_range_filter": q(
        f"SELECT {KEPT}, target_entity_health_pct_before, target_entity_health_pct_after FROM refined",
        REFINED),
    "silver_bounds_filter": q(f"""SELECT {KEPT} FROM ev
        WHERE coalesce(damage_amount BETWEEN 0 AND 50000, true)
          AND coalesce(healing_amount >= 0, true)
          AND coalesce(target_entity_health_pct_after BETWEEN 10 AND 100, true)"""),
    "silver_enrich": q(f"""SELECT event_id, {LATENCY} AS ingest_latency_ms,
        {MASSIVE} AS is_massive_hit, event_date FROM ev"""),
    "silver_refined": q(f"""SELECT {KEPT}, {MASSIVE} AS is_massive_hit,
        {LATENCY} AS ingest_latency_ms, event_date FROM refined""", REFINED),
    "silver_refine_report": q(f"""SELECT (SELECT count(*) FROM twice) AS rows_in,
        (SELECT count(*) FROM twice) - count(*) AS duplicates_removed,
        count(*) FILTER ({BAD_HEALTH}) AS bad_target_entity_health_pct_before,
        count(*) FILTER (NOT {BAD_HEALTH} AND {BAD_AFTER}) AS bad_target_entity_health_pct_after,
        count(*) FILTER (NOT {BAD_HEALTH} AND NOT {BAD_AFTER}) AS rows_after_validation FROM ev"""),
    "silver_new_only": q(f"SELECT {KEPT} FROM ev WHERE NOT ({FIRST})"),
    "text_casts": q("""SELECT event_id, event_type, timestamp, damage_amount, server_latency_ms,
        is_critical_hit, CASE WHEN event_type = 'heal' THEN 'damage_amount' ELSE '' END AS failed
        FROM ev"""),
    "live_feed": q("""SELECT raid_id, event_type,
        coalesce(nullif(damage_amount, 0), nullif(healing_amount, 0)) AS amount FROM ev"""),
    "legacy_columns": q("""SELECT raid_id AS raidid, event_type AS eventtype,
        source_player_id AS sourceplayerid, damage_amount AS damageamount,
        is_critical_hit AS iscriticalhit FROM ev"""),
    "event_rule_violations": q(counted_rules("ev", "ev", (UUID_RULE, *EVENT_RULES))),
    "valid_events": q("""SELECT event_id, event_type, raid_id, source_player_id, damage_amount,
        small_batch AS batch_id FROM marked WHERE broken = ''""", MARKED),
    "batch_verdict": q("SELECT * FROM judged", MARKED),
    "admitted_events": q("""SELECT event_id, event_type, raid_id, source_player_id, damage_amount,
        small_batch AS batch_id FROM marked JOIN judged ON small_batch = judged.batch_id
        WHERE status = 'accepted'""", MARKED),
    "first_errors_per_batch": q("""SELECT batch_id, idx, event_id, error_rank,
        broken AS broken_rules FROM (
          SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY idx, event_id) AS error_rank
          FROM marked WHERE broken <> '') WHERE error_rank <= 5""", MARKED),
    "gold_contract_violations": q(
        " UNION ALL ".join([
            counted_rules("s", "summ_all", (
                ("range", "n_players", "n_players < 1 OR n_players > 40"),
                ("composition", "n_players", "n_tanks + n_healers + n_dps > n_players"),
            ), "'fact_raid_summary' AS table_name, "),
            counted_rules("p", "stats_all", (
                ("required", "player_class", "player_class IS NULL"),
                ("required", "player_role", "player_role IS NULL"),
                ("length", "player_name", "length(player_name) > 12"),
            ), "'fact_player_raid_stats' AS table_name, "),
            counted_rules("d", "dimp", (
                ("domain", "player_role",
                 "player_role NOT IN ('tank', 'healer', 'dps', 'unknown')"),
            ), "'dim_player' AS table_name, "),
            counted_rules("r", "summ_all", (
                ("domain", "difficulty", "true"),
                ("range", "raid_size", "n_players < 1 OR n_players > 40"),
            ), "'dim_raid' AS table_name, "),
        ]), SUMM_ALL, STATS_ALL, dim_players("dimp", "true", "true")),
    "raid_status": q("SELECT raid_id, 'ok' AS status, '' AS reasons FROM summ", SUMM),
    "top_dps_per_raid": q(top("dps", "damage_share"), SUMM, STATS),
    "top_hps_per_raid": q(top("hps", "healing_share", "hps > 0"), SUMM, STATS),
    "top_deaths_per_raid": q(
        top("player_deaths", "", "player_deaths > 0"), SUMM,
        stats("stats", "summ", PLAYERS, "target")),
    "top_crit_per_raid": q(
        top("crit_rate", "", "damage_events + healing_events > 0"), SUMM, STATS),
    "player_averages": q("SELECT * FROM averages", SUMM, STATS, AVERAGES),
    "top_avg_dps": q("""SELECT player_id, player_name, player_class, player_role, avg_dps, raids
        FROM averages ORDER BY avg_dps DESC, player_id LIMIT 5""", SUMM, STATS, AVERAGES),
    "top_avg_hps": q("""SELECT player_id, player_name, player_class, player_role, avg_hps, raids
        FROM averages WHERE avg_hps > 0 ORDER BY avg_hps DESC, player_id LIMIT 5""",
        SUMM, STATS, AVERAGES),
    "top_dps_overall": q("""SELECT player_id, player_name, player_class, player_role, dps, raid_id
        FROM stats ORDER BY dps DESC, player_id LIMIT 3""", SUMM, STATS),
    "top_classes": q(f"""SELECT source_player_class, count(*) AS events,
        {pct('count(*)', '(SELECT count(*) FROM ev WHERE source_player_class IS NOT NULL)')} AS pct
        FROM ev WHERE source_player_class IS NOT NULL GROUP BY source_player_class
        ORDER BY events DESC, source_player_class LIMIT 10"""),
    "event_type_profile": q(f"""SELECT event_type, count(*) AS events,
        {pct('count(*)', '(SELECT count(*) FROM ev)')} AS pct FROM ev GROUP BY event_type"""),
    "role_profile": q(f"""SELECT source_player_role, count(*) AS events,
        {pct('count(*)', '(SELECT count(*) FROM ev WHERE source_player_role IS NOT NULL)')} AS pct
        FROM ev WHERE source_player_role IS NOT NULL GROUP BY source_player_role"""),
    "raid_profile": q(f"""SELECT raid_id, count(DISTINCT batch_id) AS files, count(*) AS events,
        {', '.join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in TYPES)},
        count(source_player_class) AS with_class, count(source_player_role) AS with_role
        FROM ev GROUP BY raid_id"""),
    "raid_type_profile": q(f"""SELECT raid_id, event_type, events,
        {pct('events', 'whole')} AS pct FROM (
          SELECT raid_id, event_type, count(*) AS events,
            sum(count(*)) OVER (PARTITION BY raid_id) AS whole
          FROM ev GROUP BY raid_id, event_type)"""),
    "amount_profile": q("""SELECT count(d) AS damage_rows,
        CAST(round(CAST(avg(d) AS DECIMAL(38,9)), 4) AS DOUBLE) AS damage_mean,
        CAST(round(CAST(stddev_samp(d) AS DECIMAL(38,9)), 4) AS DOUBLE) AS damage_stdev,
        min(d) AS damage_min, max(d) AS damage_max, count(h) AS heal_rows,
        CAST(round(CAST(avg(h) AS DECIMAL(38,9)), 4) AS DOUBLE) AS heal_mean,
        CAST(round(CAST(stddev_samp(h) AS DECIMAL(38,9)), 4) AS DOUBLE) AS heal_stdev
        FROM (SELECT CASE WHEN event_type = 'combat_damage' THEN nullif(damage_amount, 0) END AS d,
          CASE WHEN event_type = 'heal' THEN nullif(healing_amount, 0) END AS h FROM ev)"""),
    "dim_distribution": q("""SELECT 'player_role' AS attribute, player_role AS value,
        count(*) AS players FROM dim GROUP BY player_role UNION ALL
        SELECT 'player_class', player_class, count(*) FROM dim GROUP BY player_class""",
        dim_players("dim")),
    "grand_totals": q("""SELECT count(*) AS raids,
        CAST(sum(CAST(total_damage AS DECIMAL(28,4))) AS DOUBLE) AS total_damage,
        CAST(sum(CAST(total_healing AS DECIMAL(28,4))) AS DOUBLE) AS total_healing,
        CAST(sum(total_player_deaths) AS BIGINT) AS total_deaths,
        count(*) FILTER (raid_outcome = 'success') AS successes FROM summ""", SUMM),
    "massive_hit_rate": q(f"""SELECT count(*) AS events, count(*) FILTER ({MASSIVE}) AS massive_hits,
        {pct(f'count(*) FILTER ({MASSIVE})', 'count(*)')} AS massive_pct FROM ev"""),
    "batch_cardinality": q("""SELECT batch_id, count(event_type) AS events,
        count(DISTINCT raid_id) AS raids, count(DISTINCT event_type) AS event_types,
        count(DISTINCT source_player_id) AS players FROM ev GROUP BY batch_id"""),
    "batch_event_types": q("""SELECT batch_id,
        string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS values
        FROM ev GROUP BY batch_id"""),
    "row_sample": q("""SELECT event_id, event_type, damage_amount FROM ev
        ORDER BY timestamp, event_id LIMIT 3"""),
    "partition_discovery": q("SELECT DISTINCT raid_id, event_date FROM ev"),
    "union_concat": q(f"""SELECT event_id, raid_id,
        CASE WHEN {FIRST} THEN resource_type END AS resource_type FROM ev"""),
    "merged_counts": q("SELECT event_type, count(*) AS events FROM ev GROUP BY event_type"),
    "event_chunks": q("""SELECT raid_id, event_id, seq, (seq - 1) // 25 + 1 AS chunk FROM (
        SELECT raid_id, event_id,
          row_number() OVER (PARTITION BY raid_id ORDER BY timestamp, event_id) AS seq FROM ev)"""),
    "encounter_elapsed": q("""SELECT raid_id, event_id,
        date_sub('millisecond', min(timestamp) OVER (PARTITION BY raid_id), timestamp)
          AS elapsed_ms FROM ev"""),
    "boss_timeline": q("""SELECT raid_id, event_id, target_entity_id, hit, damage_amount,
        hp_pct_before, hp_pct_after, phase, is_transition FROM line""", TIMELINE),
    "boss_transitions": q("""SELECT raid_id, timestamp, 'boss_phase' AS event_type,
        target_entity_id AS source_player_id, target_entity_id, 'boss' AS target_entity_type,
        hp_pct_before AS target_entity_health_pct_before,
        hp_pct_after AS target_entity_health_pct_after, phase,
        'boss_phase_' || CAST(phase AS VARCHAR) AS flag FROM line WHERE is_transition""", TIMELINE),
    "event_order_check": q("SELECT * FROM disorder", DISORDER.format(source="twice")),
    "orphan_players": q("""SELECT DISTINCT player_id FROM stats_all
        WHERE player_id NOT IN (SELECT player_id FROM one)""",
        SUMM_ALL, STATS_ALL, dim_players("one", FIRST)),
    "raid_fk": q("""SELECT raid_id, 'fact' AS only_in FROM summ
        WHERE raid_id NOT IN (SELECT raid_id FROM older) UNION ALL
        SELECT raid_id, 'dim' FROM older WHERE raid_id NOT IN (SELECT raid_id FROM summ)""",
        SUMM, dim_raids("older", FIRST)),
    "share_checks": q(f"""SELECT 'damage_share' AS check_id, raid_id AS scope,
        {SHARE_STATUS.format('damage_share')} AS status, '1' AS expected,
        CAST(round(sum(damage_share), 4) AS DOUBLE) AS observed
        FROM stats GROUP BY raid_id UNION ALL
        SELECT 'healing_share', raid_id, {SHARE_STATUS.format('healing_share')}, '1',
        CAST(round(sum(healing_share), 4) AS DOUBLE) FROM stats GROUP BY raid_id""", SUMM, STATS),
    "coherence": q("""SELECT check_id, status, expected, count(*) AS scopes FROM (
        SELECT 'player_fk' AS check_id, 'ok' AS status, '0 orphan players' AS expected
        UNION ALL SELECT 'raid_fk', 'ok', '0 unmatched raids'
        UNION ALL SELECT 'damage_share', CASE WHEN sum(damage_share) = 0 THEN 'warn'
          WHEN abs(sum(damage_share) - 1) < 0.01 THEN 'ok' ELSE 'fail' END, '1'
          FROM stats GROUP BY raid_id
        UNION ALL SELECT 'healing_share', CASE WHEN sum(healing_share) = 0 THEN 'warn'
          WHEN abs(sum(healing_share) - 1) < 0.01 THEN 'ok' ELSE 'fail' END, '1'
          FROM stats GROUP BY raid_id
        UNION ALL SELECT 'roles', CASE WHEN n_tanks + n_healers + n_dps <= n_players THEN 'ok'
          ELSE 'fail' END, '<= n_players' FROM summ
        UNION ALL SELECT 'boss_hp', CASE WHEN boss_min_hp_pct BETWEEN 0 AND 100 THEN 'ok'
          ELSE 'fail' END, '0..100' FROM summ
        UNION ALL SELECT 'crit_rate', CASE WHEN count(*) FILTER (crit_rate < 0 OR crit_rate > 1) = 0
          THEN 'ok' ELSE 'fail' END, '0 rows outside 0..1' FROM stats GROUP BY raid_id
        UNION ALL SELECT 'rates', CASE WHEN count(*) FILTER (dps < 0 OR hps < 0) = 0
          THEN 'ok' ELSE 'fail' END, '0 negative rates' FROM stats GROUP BY raid_id
        UNION ALL SELECT 'raid_size', 'ok', '<= raid_size' FROM summ
        UNION ALL SELECT 'known_player_class', CASE WHEN count(*) FILTER (player_class = 'unknown')
          = 0 THEN 'ok' ELSE 'warn' END, '0 unknown' FROM dim
        UNION ALL SELECT 'known_player_role', CASE WHEN count(*) FILTER (player_role = 'unknown')
          = 0 THEN 'ok' ELSE 'warn' END, '0 unknown' FROM dim
      ) GROUP BY ALL""", SUMM, STATS, dim_players("dim")),
    "summary_checks": q("""SELECT 'roles' AS check_id, raid_id AS scope,
        CASE WHEN n_tanks + n_healers + n_dps <= n_players THEN 'ok' ELSE 'fail' END AS status,
        CAST(n_tanks + n_healers + n_dps AS VARCHAR) AS observed, '<= n_players' AS expected FROM summ
        UNION ALL SELECT 'boss_hp', raid_id,
        CASE WHEN boss_min_hp_pct BETWEEN 0 AND 100 THEN 'ok' ELSE 'fail' END,
        CAST(boss_min_hp_pct AS VARCHAR), '0..100' FROM summ""", SUMM),
    "raid_size_checks": q("""SELECT 'raid_size' AS check_id, s.raid_id AS scope,
        CASE WHEN n_players <= raid_size THEN 'ok' ELSE 'fail' END AS status,
        CAST(n_players AS VARCHAR) AS observed, '<= raid_size' AS expected
        FROM summ s LEFT JOIN older o ON s.raid_id = o.raid_id""",
        SUMM, dim_raids("older", f"{FIRST} AND {PLAYERS}")),
    "label_checks": q("""SELECT 'known_player_class' AS check_id, 'all' AS scope,
        CASE WHEN count(*) FILTER (player_class = 'unknown') = 0 THEN 'ok' ELSE 'warn' END AS status,
        CAST(count(*) FILTER (player_class = 'unknown') AS VARCHAR) AS observed,
        '0 unknown' AS expected FROM dim UNION ALL
        SELECT 'known_player_role', 'all',
        CASE WHEN count(*) FILTER (player_role = 'unknown') = 0 THEN 'ok' ELSE 'warn' END,
        CAST(count(*) FILTER (player_role = 'unknown') AS VARCHAR), '0 unknown' FROM dim""",
        dim_players("dim", "true", "true")),
    "layer_reconciliation": q("""SELECT 'silver' AS layer, (SELECT count(*) FROM twice) AS source_rows,
        count(*) AS target_rows, abs((SELECT count(*) FROM twice) - count(*)) AS difference,
        CASE WHEN count(*) = (SELECT count(*) FROM twice) THEN 'ok' ELSE 'fail' END AS status
        FROM refined""", REFINED),
    "dataset_checkpoints": q("""
      SELECT check_id, 'all' AS scope, CASE WHEN passed THEN 'ok' ELSE 'fail' END AS status,
        observed, expected FROM (
        SELECT 'raids' AS check_id, raids = 30 AS passed, CAST(raids AS VARCHAR) AS observed,
          '30' AS expected FROM t
        UNION ALL SELECT 'volume', n >= 1000, CAST(n AS VARCHAR), '>= 1000' FROM t
        UNION ALL SELECT 'type_present', wanted > 0, CAST(wanted AS VARCHAR), 'combat_damage' FROM t
        UNION ALL SELECT 'type_share', wanted / n > 0.4,
          CAST(CAST(round(CAST(wanted / n AS DECIMAL(18,10)), 4) AS DOUBLE) AS VARCHAR), '> 0.4' FROM t
        UNION ALL SELECT 'phases', phases >= 10, CAST(phases AS VARCHAR), '>= 10' FROM t)""",
        """t AS (SELECT count(DISTINCT raid_id) AS raids, count(*) AS n,
          count(*) FILTER (event_type = 'combat_damage') AS wanted,
          count(*) FILTER (event_type = 'boss_phase') AS phases FROM ev)"""),
    "class_role_conformity": q(f"""SELECT source_player_class, source_player_role,
        count(*) AS events, max(r) IS NOT NULL AS allowed
        FROM ev LEFT JOIN {CLASS_ROLES} ON source_player_class = c AND source_player_role = r
        WHERE source_player_class IS NOT NULL AND source_player_role IS NOT NULL
        GROUP BY source_player_class, source_player_role"""),
    "order_checks": q("""SELECT 'unique_ids' AS check_id, raid_id AS scope,
        CASE WHEN repeated_ids = 0 THEN 'ok' ELSE 'fail' END AS status,
        CAST(repeated_ids AS VARCHAR) AS observed, '0' AS expected FROM disorder UNION ALL
        SELECT 'time_order', raid_id, CASE WHEN out_of_order = 0 THEN 'ok' ELSE 'fail' END,
        CAST(out_of_order AS VARCHAR), '0' FROM disorder UNION ALL
        SELECT 'enough_events', raid_id, CASE WHEN events >= 100 THEN 'ok' ELSE 'fail' END,
        CAST(events AS VARCHAR), '>= 100' FROM disorder""", DISORDER.format(source="ev")),
    "path_keys": q(f"""SELECT event_id,
        'raid_id=' || raid_id || '/ingest_date=' || strftime(timestamp, '%Y-%m-%d')
          || '/batch_' || batch_id || '.json' AS bronze_key,
        'raid_id=' || raid_id || '/event_date=' || CAST(event_date AS VARCHAR)
          || '/part-' || batch_id || '.parquet' AS silver_key,
        batch_id AS named_batch, substr(md5('x/' || event_id), 1, 8) AS hashed_batch,
        raid_id AS raid_from_path, raid_id AS raid_from_folder,
        strftime(timestamp, '%Y-%m-%d') AS date_from_path,
        raid_id || '_batch_' || printf('%04d', idx) || '.json' AS chunk_file,
        substr({MD5_ID}, 1, 8) || '-' || substr({MD5_ID}, 9, 4) || '-' || substr({MD5_ID}, 13, 4)
          || '-' || substr({MD5_ID}, 17, 4) || '-' || substr({MD5_ID}, 21, 12) AS derived_id
        FROM ev"""),
    "scalar_functions": q(f"""SELECT event_id, event_type AS type_clean,
        length(source_player_name) AS name_length, {PLAYERS} AS is_player,
        regexp_matches(raid_id, '^raid\\d{{3}}$') AS raid_ok,
        split_part(event_id, '_', 2) AS id_part, strftime(timestamp, '%Y-%m-%d') AS ingest_date,
        CASE WHEN target_entity_health_pct_before IS NULL THEN 100.0::DOUBLE
          ELSE greatest(0.0::DOUBLE, least(100.0::DOUBLE, target_entity_health_pct_before)) END AS clamped,
        {div('server_latency_ms', 'server_latency_ms % 7')} AS safe_ratio,
        {pct('server_latency_ms', '80')} AS pct,
        CAST(server_latency_ms AS DOUBLE) / 1000.0::DOUBLE AS latency_s,
        CAST(server_latency_ms AS DOUBLE) / 60000.0::DOUBLE AS latency_min,
        CASE WHEN n * 331 < 1024 THEN CAST(n * 331 AS VARCHAR) || ' B'
          WHEN n * 331 < 1048576 THEN printf('%.2f KB', CAST(n * 331 AS DOUBLE) / 1024)
          ELSE printf('%.2f MB', CAST(n * 331 AS DOUBLE) / 1048576) END AS readable,
        (1.0::DOUBLE - CAST(n AS DOUBLE) / CAST(n + 1000 AS DOUBLE)) * 100.0::DOUBLE AS reduction,
        least(damage_amount, healing_amount) AS least_amount,
        greatest(damage_amount, healing_amount) AS greatest_amount,
        coalesce(source_player_class, 'unknown') AS class_or_unknown FROM ev"""),
    "bronze_round_trip": q("""SELECT event_id, event_type, raid_id, source_player_id,
        damage_amount, target_entity_health_pct_before, timestamp, batch_id, false AS is_blocked,
        1.0::DOUBLE AS critical_multiplier, 'wow-raid-addon-v1.2' AS source_system FROM ev"""),
    "bronze_batch_sizes": q("""SELECT batch_id, 'envelope' AS shape, 'ok' AS status,
        count(*) AS events FROM ev GROUP BY batch_id"""),
    "event_date_landing": q("""SELECT raid_id, strftime(timestamp, '%Y-%m-%d') AS ingest_date,
        count(*) AS events FROM ev GROUP BY ALL"""),
    "bronze_landing_totals": q("""SELECT raid_id, '2024-02-01' AS ingest_date, 'ok' AS status,
        count(*) AS events FROM ev GROUP BY raid_id"""),
    "replay_batches": q("""SELECT raid_id, event_id,
        printf('%04d', (row_number() OVER (PARTITION BY raid_id ORDER BY timestamp, event_id) - 1) // 25 + 1)
          AS batch_index FROM ev"""),
    "replay_single_events": q("""SELECT 'raid001' AS raid_id, event_id, k AS chunk,
        'raid001_batch_' || printf('%04d', k) || '.json' AS chunk_file FROM (
          SELECT event_id, row_number() OVER (ORDER BY timestamp, event_id) AS k FROM ev)"""),
    "silver_round_trip": q(f"""SELECT event_id, event_type, raid_id, source_player_id,
        damage_amount, target_entity_health_pct_before, {MASSIVE} AS is_massive_hit,
        {LATENCY} AS ingest_latency_ms, event_date FROM refined""", REFINED),
    "silver_partition_scan": q("""SELECT event_id, raid_id, event_date, damage_amount FROM ev
        WHERE raid_id = 'raid007' AND event_date = DATE '2024-01-07'"""),
    "layer_inventory": q("""SELECT DISTINCT raid_id, CAST(event_date AS VARCHAR) AS date,
        true AS has_bytes FROM ev"""),
    "gold_publication": q("""SELECT 'dim_player' AS table_name, count(*) AS rows FROM dim
        UNION ALL SELECT 'dim_raid', count(*) FROM summ
        UNION ALL SELECT 'fact_raid_summary', count(*) FROM summ
        UNION ALL SELECT 'fact_player_raid_stats', count(*) FROM stats""",
        SUMM, STATS, dim_players("dim")),
    "gold_published_stats": q("""SELECT * REPLACE (
        CAST(round(CAST(crit_rate AS DECIMAL(38,12)), 6) AS DOUBLE) AS crit_rate) FROM stats""",
        SUMM, STATS),
    "medallion_summary": q(
        "SELECT * FROM summ",
        f"refined AS (SELECT * FROM ev WHERE NOT {BAD_HEALTH} AND NOT {BAD_AFTER})",
        SUMM.replace("FROM ev ", "FROM refined ")),
    "stream_ingest": q("""SELECT event_id, event_type, raid_id, small_batch AS batch_id
        FROM marked WHERE broken = ''""", MARKED),
    "ingest_rejects": q("""SELECT 'row' AS mode, event_id,
        CASE WHEN broken = '' THEN 'accepted' ELSE 'refused' END AS status,
        nullif(broken, '') AS reasons, CAST(NULL AS VARCHAR) AS batch_reasons FROM marked
        UNION ALL SELECT 'batch', event_id,
        CASE WHEN bad = 0 THEN 'accepted' ELSE 'refused' END, CASE WHEN bad > 0 THEN broken END,
        CASE WHEN bad > 0 THEN 'invalid_events' END FROM (
          SELECT *, count(*) FILTER (broken <> '') OVER (PARTITION BY raid_id, batch_id) AS bad
          FROM marked)""", MARKED),
    "bronze_shapes": q("""SELECT event_id,
        ['array', 'envelope', 'single', 'envelope', 'array', 'array', 'blank', 'malformed', 'malformed'][kind + 1] AS shape,
        CAST([1, 1, 1, 1, 1, 0, 0, 0, 0][kind + 1] AS BIGINT) AS event_count,
        ['ok', 'ok', 'ok', 'ok', 'ok', 'empty', 'empty', 'malformed', 'malformed'][kind + 1] AS status
        FROM (SELECT event_id, CAST(n % 9 AS INT) AS kind FROM ev)"""),
    "extra_fields": q("""SELECT event_id, n % 4 = 0 AS has_extra,
        CASE WHEN n % 4 = 0 THEN 'zone' ELSE '' END AS extra FROM ev"""),
    "flag_arrays": q("""SELECT event_id, CASE WHEN n % 3 = 0 THEN 'late,' || event_type ELSE '' END AS flags,
        CAST(CASE WHEN n % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_flags FROM ev"""),
    "column_checks": q("""SELECT 'columns' AS check_id, 'all' AS scope, 'fail' AS status, 'zone' AS observed,
        'none absent' AS expected UNION ALL
        SELECT 'has_rows', 'all', CASE WHEN count(*) > 0 THEN 'ok' ELSE 'fail' END,
        CAST(least(count(*), 1) AS VARCHAR), '> 0' FROM ev"""),
    "stamped_players": q("""SELECT player_id, total_raids, TIMESTAMP '2024-01-30 00:00:00' AS ingested_at FROM dim""",
        dim_players("dim")),
    "landing_totals": q("""SELECT 'ok' AS status, count(DISTINCT raid_id || batch_id) AS batches, count(*) AS events,
        true AS has_bytes FROM ev"""),
    "gold_published_raids": q("SELECT *, n_players AS raid_size FROM summ", SUMM),
    "gold_published_players": q("SELECT * FROM dim", dim_players("dim")),
    "gold_published_impact": q("""SELECT raid_id, event_date, player_id, player_name, impact_score,
        'unknown' AS style_cluster FROM scored""", SUMM, STATS, IMPACT),
    "impact_contract": q("""SELECT 'domain' AS rule, 'style_cluster' AS "column", count(*) AS broken_rows
          FROM placed WHERE place % 5 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'length', 'player_name', count(*) FROM placed WHERE place % 7 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'range', 'impact_score', count(*) FROM placed WHERE place = 1 AND impact_score > 0
          HAVING count(*) > 0""", SUMM, STATS, IMPACT,
        """placed AS (SELECT *, row_number() OVER (PARTITION BY raid_id ORDER BY impact_score DESC, player_id) AS place
          FROM scored)"""),
    "impact_published_rejects": q("""SELECT t.table_name, 'length' AS rule, 'player_name' AS "column", count(*) AS broken_rows
        FROM stats, (VALUES ('fact_player_raid_stats'), ('player_impact_index')) t(table_name)
        WHERE player_id LIKE '%3' GROUP BY ALL""", SUMM, STATS),
    "raid_status_failures": q("""SELECT raid_id, CASE WHEN raid_id LIKE '%3' OR raid_id LIKE '%5' THEN 'failed' ELSE 'ok' END AS status,
        CASE WHEN raid_id LIKE '%3'
            THEN 'fact_player_raid_stats.crit_rate:range,fact_raid_summary.n_players:range'
          WHEN raid_id LIKE '%5' THEN 'fact_raid_summary.n_players:range' ELSE '' END AS reasons FROM summ""", SUMM),
    "catalogue_partitions": q("""SELECT raid_id, event_date, player_id, damage_total FROM stats
        WHERE raid_id <> 'raid007' OR healing_total > 0""", SUMM, STATS),
    "run_catalogue": q("""SELECT 'run_' || CAST(i AS VARCHAR) AS run_id, '2024-01-30T00:00:00' AS timestamp_start,
        '2024-01-30T00:0' || CAST(i AS VARCHAR) || ':00' AS timestamp_end, kind AS mode,
        count(event_type) AS events_generated, CAST(60 * i AS DOUBLE) AS elapsed_seconds,
        round(CAST(count(event_type) AS DOUBLE) / CAST(60 * i AS DOUBLE), 6) AS events_per_second
        FROM (VALUES (1, 'combat_damage'), (2, 'heal')) r(i, kind) LEFT JOIN ev ON event_type = kind
        GROUP BY i, kind"""),
    "prefix_styles": q("""SELECT DISTINCT CASE WHEN raid_id LIKE '%4' THEN 'raidid' ELSE 'raid_id' END AS style,
        raid_id, true AS has_files, true AS has_bytes FROM ev"""),
    "newest_file": q("""SELECT raid_id FROM ev GROUP BY raid_id ORDER BY count(*), raid_id LIMIT 1"""),
    "reference_checks": q("""SELECT 'role_entries' AS check_id, source_player_role AS scope, 'ok' AS status,
        CAST(count(DISTINCT source_player_class) AS DOUBLE) AS observed, '> 0' AS expected FROM ev
        WHERE source_player_role IS NOT NULL GROUP BY source_player_role
        UNION ALL SELECT DISTINCT 'weight_sum', source_player_role, 'ok', CAST(1 AS DOUBLE), '1' FROM ev
        WHERE source_player_role IS NOT NULL"""),
    "gold_part": q("""SELECT * REPLACE (
        CAST(round(CAST(crit_rate AS DECIMAL(38,12)), 6) AS DOUBLE) AS crit_rate) FROM stats
        WHERE raid_id = 'raid007'""", SUMM, STATS),
    "gold_partition_rerun": q("""SELECT * REPLACE (
        CAST(round(CAST(crit_rate AS DECIMAL(38,12)), 6) AS DOUBLE) AS crit_rate) FROM stats""", SUMM, STATS),
    "single_batch_refine": q(f"""SELECT event_id, raid_id, event_date, damage_amount FROM ev
        WHERE batch_id = 'b000000001' AND NOT {BAD_HEALTH} AND NOT {BAD_AFTER}"""),
    "stream_refine": q(f"""SELECT event_id, event_type, raid_id, event_date, damage_amount,
        {MASSIVE} AS is_massive_hit FROM refined""", REFINED),
    "stream_metrics": q(f"""SELECT CAST(CASE WHEN {FIRST} THEN 0 ELSE 1 END AS BIGINT) AS micro_batch,
        count(*) AS events, count(*) FILTER (broken = '') AS accepted, count(*) FILTER (broken <> '') AS refused,
        min(timestamp) AS first_event, max(timestamp) AS last_event, CAST(sum(k * 37) AS BIGINT) AS delay_ms,
        round(CAST(sum(k * 37) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS mean_delay_ms
        FROM marked GROUP BY ALL""", MARKED),
    "ingest_file_rejects": q("""SELECT event_id, CASE n % 3 WHEN 0 THEN 'empty' ELSE 'too_large' END AS reasons
        FROM ev WHERE event_type = 'player_death' AND n % 3 < 2 UNION ALL SELECT 'none', 'empty'"""),
    "silver_rejects": q("""SELECT event_id,
        CASE WHEN n % 7 = 0 THEN 'no_readable_time' ELSE 'health_out_of_range' END AS reason
        FROM ev WHERE n % 7 = 0 OR target_entity_health_pct_before NOT BETWEEN 0 AND 100
          OR target_entity_health_pct_after NOT BETWEEN 0 AND 100
        UNION ALL SELECT 'all', '0'"""),
    "replay_sent": q("""SELECT (position - 1) // 20 AS call, raid_id, position,
        CASE WHEN position < 10000 THEN printf('%04d', position) ELSE CAST(position AS VARCHAR) END AS batch_index,
        least(25, n - (position - 1) * 25) AS events
        FROM (SELECT raid_id, n, unnest(range(1, (n + 24) // 25 + 1)) AS position
          FROM (SELECT raid_id, count(*) AS n FROM ev GROUP BY raid_id))"""),
    "gold_rerun_players": q(f"""SELECT source_player_id AS player_id, count(DISTINCT raid_id) AS total_raids
        FROM ev WHERE {PLAYERS} AND NOT (raid_id = 'raid007' AND source_player_id LIKE '%3') GROUP BY ALL"""),
    "layer_comparison": q(f"""SELECT 'column' AS aspect, 'batch_id' AS item, 'string' AS before, 'absent' AS after
        UNION ALL SELECT 'column', 'event_date', 'absent', 'date'
        UNION ALL SELECT 'column', 'ingest_latency_ms', 'absent', 'bigint'
        UNION ALL SELECT 'column', 'is_massive_hit', 'absent', 'boolean'
        UNION ALL SELECT 'column', 'ingestion_timestamp', 'timestamp_ntz', 'timestamp'
        UNION ALL SELECT 'column', 'timestamp', 'timestamp_ntz', 'timestamp'
        UNION ALL SELECT 'size', 'bytes', 'true', 'true'
        UNION ALL SELECT 'rows', 'rows', CAST((SELECT count(*) FROM twice) AS VARCHAR), CAST(count(*) AS VARCHAR) FROM ev
          WHERE coalesce(target_entity_health_pct_before BETWEEN 0 AND 100, true)
            AND coalesce(target_entity_health_pct_after BETWEEN 0 AND 100, true)
        UNION ALL SELECT 'rows', 'massive_hits', NULL, CAST(count(*) FILTER ({MASSIVE}) AS VARCHAR) FROM ev
          WHERE coalesce(target_entity_health_pct_before BETWEEN 0 AND 100, true)
            AND coalesce(target_entity_health_pct_after BETWEEN 0 AND 100, true)"""),
    "stream_feed": q("""SELECT raid_id, event_type, count(*) AS events,
        count(coalesce(nullif(damage_amount, 0), nullif(healing_amount, 0))) AS with_amount
        FROM ev GROUP BY ALL"""),
    "delivery_totals": q(f"""SELECT count(*) AS batches,
        count(*) FILTER (status = 'accepted') AS delivered,
        count(*) FILTER (status <> 'accepted') AS failed,
        {pct("count(*) FILTER (status = 'accepted')", 'count(*)')} AS success_pct FROM judged""",
        MARKED),
    "replay_order": q("""SELECT raid_id, position,
        printf('%04d', position) AS batch_index FROM (
          SELECT raid_id, unnest(range(1, (count(*) + 24) // 25 + 1)) AS position
          FROM ev GROUP BY raid_id)"""),
}
