"""Registrations: notebook analyses (N*) over legacy-sheet rows derived from
the driver's tables.  The club -> state dimension is the TPC-H nation ->
region table (25 rows), the analogue of the notebook's club dictionary."""

from __future__ import annotations

from pyspark.sql import functions as F

from varzea.operators import legacy as N
from varzea.plans.catalog import register
from varzea.plans.oracle import with_ctes
from varzea.plans.registry_library import SEASON
from varzea.sources import feeds as FD

_LEGACY = """
legacy AS (
  SELECT strftime(data, '%Y-%m-%d') AS "Data", dayname(data) AS "Dia",
         ' ' || upper(substr(mandante, 1, 1)) || lower(substr(mandante, 2)) || ' ' AS "Clube 1",
         ' ' || upper(substr(visitante, 1, 1)) || lower(substr(visitante, 2)) || ' ' AS "Clube 2",
         CASE WHEN gols_mandante IS NOT NULL THEN ' ' || CAST(gols_mandante AS VARCHAR) || 'x' || CAST(gols_visitante AS VARCHAR) || ' ' END AS "Placar",
         CASE WHEN gols_mandante > gols_visitante THEN ' ' || upper(substr(mandante, 1, 1)) || lower(substr(mandante, 2)) || ' '
              WHEN gols_mandante < gols_visitante THEN ' ' || upper(substr(visitante, 1, 1)) || lower(substr(visitante, 2)) || ' '
              WHEN gols_mandante = gols_visitante THEN ' - ' END AS "Vencedor",
         arena AS "Arena"
  FROM partidas
),
split AS (
  SELECT trim("Data") AS "Data", trim("Dia") AS "Dia", trim("Clube 1") AS "Clube 1", trim("Clube 2") AS "Clube 2",
         trim("Vencedor") AS "Vencedor", trim("Arena") AS "Arena",
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 1)) AS BIGINT) AS p1,
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 2)) AS BIGINT) AS p2
  FROM legacy
),
states AS (
  SELECT lower(n.n_name) AS k, r.r_name AS e FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
with_states AS (
  SELECT s.*, s1.e AS "C1 Estado", s2.e AS "C2 Estado", COALESCE(s3.e, 'Empate') AS "Vencedor Estado"
  FROM split s
  LEFT JOIN states s1 ON lower(trim(s."Clube 1")) = s1.k
  LEFT JOIN states s2 ON lower(trim(s."Clube 2")) = s2.k
  LEFT JOIN states s3 ON lower(trim(s."Vencedor")) = s3.k
)"""


def _sheet(lk):
    return FD.legacy_sheet_rows(lk.partidas)


def _states(lk):
    n, r = lk.raw("nation"), lk.raw("region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("clube"), F.col("r_name").alias("estado"))


def _with_states(lk):
    return N.with_states(N.split_score(_sheet(lk)), _states(lk))


register("n01_split_score", with_ctes(_LEGACY, "SELECT * FROM split"))(lambda lk: N.split_score(_sheet(lk)))

register("n02_null_profile", with_ctes(_LEGACY, """
SELECT 'Data' AS coluna, COUNT(*) FILTER (WHERE "Data" IS NULL) AS nulos FROM legacy
UNION ALL SELECT 'Dia', COUNT(*) FILTER (WHERE "Dia" IS NULL) FROM legacy
UNION ALL SELECT 'Clube 1', COUNT(*) FILTER (WHERE "Clube 1" IS NULL) FROM legacy
UNION ALL SELECT 'Clube 2', COUNT(*) FILTER (WHERE "Clube 2" IS NULL) FROM legacy
UNION ALL SELECT 'Placar', COUNT(*) FILTER (WHERE "Placar" IS NULL) FROM legacy
UNION ALL SELECT 'Vencedor', COUNT(*) FILTER (WHERE "Vencedor" IS NULL) FROM legacy
UNION ALL SELECT 'Arena', COUNT(*) FILTER (WHERE "Arena" IS NULL) FROM legacy"""))(
    lambda lk: N.null_profile(_sheet(lk)))

register("n03_club_list", with_ctes(_LEGACY, """
SELECT DISTINCT lower(trim("Clube 1")) AS clube FROM legacy
UNION SELECT DISTINCT lower(trim("Clube 2")) FROM legacy"""))(lambda lk: N.club_list(_sheet(lk)))

register("n04_with_states", with_ctes(_LEGACY, "SELECT * FROM with_states"))(_with_states)

register("n05_wins_by_state", with_ctes(_LEGACY, """
SELECT "Vencedor Estado" AS estado, COUNT(*) AS partidas FROM with_states GROUP BY "Vencedor Estado" """))(
    lambda lk: N.wins_by_state(_with_states(lk)))

_HIST = """
SELECT bin, ROUND(lo + bin * w, 6) AS de, ROUND(lo + (bin + 1) * w, 6) AS ate, COUNT(*) AS n FROM (
  SELECT CAST(least(floor((v - lo) / w), 49) AS INT) AS bin, lo, w FROM (
    SELECT v, lo, (hi - lo) / 50.0 AS w FROM (
      SELECT v, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
      FROM (SELECT CAST({g} AS DOUBLE) AS v, MIN(CAST({g} AS DOUBLE)) OVER () AS mn, MAX(CAST({g} AS DOUBLE)) OVER () AS mx
            FROM with_states WHERE "{st}" = "Vencedor Estado" AND {g} IS NOT NULL) a) b) c) d
GROUP BY bin, lo, w"""
register("n06_goal_histogram_casa", with_ctes(_LEGACY, _HIST.format(g="p1", st="C1 Estado")))(
    lambda lk: N.goal_histogram(_with_states(lk), "home", 50))
register("n06b_goal_histogram_fora", with_ctes(_LEGACY, _HIST.format(g="p2", st="C2 Estado")))(
    lambda lk: N.goal_histogram(_with_states(lk), "away", 50))

register("n06c_goal_histogram_clube", with_ctes(_LEGACY, _HIST.format(g="p1", st="C1 Estado").replace(
    '"C1 Estado" = "Vencedor Estado"', 'lower(trim("Clube 1")) = lower(trim("Vencedor"))')))(
    lambda lk: N.goal_histogram(_with_states(lk), "home", 50, by="clube"))

register("n07_goals_by_weekday", with_ctes(_LEGACY, """
SELECT "Dia" AS dia, p1, COUNT(*) AS partidas FROM with_states WHERE "C1 Estado" = "Vencedor Estado" GROUP BY "Dia", p1"""))(
    lambda lk: N.goals_by_weekday(_with_states(lk)))

_TABLE = f"""
slice AS (SELECT * FROM legacy WHERE CAST("Data" AS DATE) BETWEEN DATE '{SEASON}-01-01' AND DATE '{SEASON}-12-31'),
sides AS (
  SELECT lower(trim("Clube 1")) AS clube, COALESCE(lower(trim("Vencedor")), 'nan') AS w,
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 1)) AS BIGINT) AS gp,
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 2)) AS BIGINT) AS gc FROM slice
  UNION ALL
  SELECT lower(trim("Clube 2")), COALESCE(lower(trim("Vencedor")), 'nan'),
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 2)) AS BIGINT),
         TRY_CAST(trim(split_part(trim("Placar"), 'x', 1)) AS BIGINT) FROM slice
),
tbl AS (
  SELECT clube AS "Clubes", 3 * COUNT(*) FILTER (WHERE w = clube) + COUNT(*) FILTER (WHERE w = '-') AS "PG",
         COUNT(*) AS "J", COUNT(*) FILTER (WHERE w = clube) AS "V", COUNT(*) FILTER (WHERE w = '-') AS "E",
         COUNT(*) FILTER (WHERE w <> clube AND w <> '-') AS "D",
         CAST(SUM(gp) AS BIGINT) AS "GP", CAST(SUM(gc) AS BIGINT) AS "GC", CAST(SUM(gp) - SUM(gc) AS BIGINT) AS "SG"
  FROM sides GROUP BY clube
)"""


def _season_table(lk):
    return N.table_from_winner(N.season_slice(_sheet(lk), f"{SEASON}-01-01", f"{SEASON}-12-31"))


register("n09_table_from_winner", with_ctes(_LEGACY + "," + _TABLE, "SELECT * FROM tbl"))(_season_table)

# adjustments given as parameters for the fixture clubs (the fixed list names real clubs)
_ADJ = [(SEASON, "nation_3", -1, -1, 1), (SEASON, "nation_7", -3, 0, 0)]
register("n11_apply_adjustments", with_ctes(_LEGACY + "," + _TABLE, """
SELECT "Clubes", "PG" + CASE "Clubes" WHEN 'nation_3' THEN -1 WHEN 'nation_7' THEN -3 ELSE 0 END AS "PG",
       "J", "V", "E" + CASE "Clubes" WHEN 'nation_3' THEN -1 ELSE 0 END AS "E",
       "D" + CASE "Clubes" WHEN 'nation_3' THEN 1 ELSE 0 END AS "D", "GP", "GC", "SG" FROM tbl"""))(
    lambda lk: N.apply_adjustments(_season_table(lk), N.adjustments_dimension(lk.spark, SEASON, _ADJ)))

register("n12_final_table", with_ctes(_LEGACY + "," + _TABLE, """
SELECT upper(substr("Clubes", 1, 1)) || lower(substr("Clubes", 2)) AS "Clubes", "PG", "J", "V", "E", "D", "GP", "GC", "SG"
FROM tbl"""))(lambda lk: N.final_table(_season_table(lk)))
