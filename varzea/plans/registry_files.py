"""Registrations: the file layer (S1-S7, K1-K4, V6).  All but S7 and V6
write files derived from the driver's tables into a scratch folder, read them
back with the library's sources and return what was read."""

from __future__ import annotations

from pyspark.sql import functions as F

from varzea.operators import payloads as J
from varzea.operators import silver as S
from varzea.operators.gold import create_views
from varzea.plans.catalog import ORACLES, register
from varzea.plans.oracle import q
from varzea.plans.registry_ingest import _GOLS_CSV, _HORA
from varzea.plans.registry_library import SEASON
from varzea.session import scratch_dir
from varzea.sources import feeds as FD
from varzea.sources import files as FS
from varzea.sources.fixtures import gold_of
from varzea.sources.sinks import export_json, publish, write_table

_ARENA = 'Estádio "X", '


def _write_csv(df, path, **options):
    df.write.mode("append").options(header=True, escape='"', **options).csv(path)


def _two_encodings(lk):
    """One folder with UTF-8 and ISO-8859-1 files, quotes and commas inside fields."""
    out = scratch_dir(lk.spark, "s01-csv")
    rows = FD.dirty_match_rows(lk.partidas.withColumn("arena", F.concat(F.lit(_ARENA), "arena")))
    for rest, encoding in enumerate(["UTF-8", "ISO-8859-1"]):
        _write_csv(rows.filter(F.col("ID").cast("bigint") % 2 == rest), out, encoding=encoding)
    return S.silver_partidas(FS.read_csv_any(lk.spark, out, S.MATCH_COLUMNS))


register("s01_csv_two_encodings", ORACLES["t07_silver_partidas"].replace(
    "vencedor, arena,", f"vencedor, '{_ARENA}' || arena AS arena,"))(_two_encodings)


_ODD_ARENA = "Estádio \ufffd \"X\",\nsetor "


def _bytes_decide(lk):
    """UTF-8 files whose text holds U+FFFD and quoted line breaks, beside ISO-8859-1 files."""
    out = scratch_dir(lk.spark, "s01c-csv")
    for rest, encoding, arena in [(0, "UTF-8", _ODD_ARENA), (1, "ISO-8859-1", _ARENA)]:
        some = lk.partidas.filter(F.col("partida_id") % 2 == rest)
        _write_csv(FD.dirty_match_rows(some.withColumn("arena", F.concat(F.lit(arena), "arena"))), out, encoding=encoding)
    return S.silver_partidas(FS.read_csv_any(lk.spark, out, S.MATCH_COLUMNS))


register("s01c_csv_bytes_decide", ORACLES["t07_silver_partidas"].replace(
    "vencedor, arena,", f"vencedor, CASE WHEN partida_id % 2 = 0 THEN 'Estádio ' || chr(65533) || ' \"X\",' || chr(10) || 'setor ' "
                        f"ELSE '{_ARENA}' END || arena AS arena,"))(_bytes_decide)


def _mixed_widths(lk):
    """One folder with goals files of 5 and of 6 columns."""
    out = scratch_dir(lk.spark, "s01b-csv")
    for rest, with_type in enumerate([True, False]):
        _write_csv(FD.dirty_goal_rows(lk.gols.filter(F.col("partida_id") % 2 == rest), with_type), out)
    return S.silver_gols(FS.read_csv_any(lk.spark, out, S.GOALS_COLUMNS, optional=1), lk.partidas)


register("s01b_csv_mixed_widths", q(_GOLS_CSV.format(tipo="CASE WHEN g.partida_id % 2 = 0 THEN g.tipo_de_gol END")))(
    _mixed_widths)


def _semicolons(lk):
    """Another separator."""
    out = scratch_dir(lk.spark, "s02-csv")
    _write_csv(FD.dirty_stats_rows(lk.estatisticas), out, sep=";")
    return S.silver_estatisticas(FS.read_csv_any(lk.spark, out, S.STATS_COLUMNS, sep=";"), lk.partidas)


register("s02_csv_separator", ORACLES["t08_silver_estatisticas"])(_semicolons)


def _stored_season(lk):
    """A stored table, one season's folder, three columns."""
    root = scratch_dir(lk.spark, "s03-lake")
    write_table(lk.partidas, f"{root}/silver/partidas", partition_by=["temporada"])
    return (FS.table(lk.spark, root, "partidas").filter(F.col("temporada") == SEASON)
            .select("partida_id", "mandante", "gols_mandante"))


register("s03_stored_season", q(f"SELECT partida_id, mandante, gols_mandante FROM partidas WHERE temporada = {SEASON}"))(
    _stored_season)


def _payload_lines(lk):
    """Fixture documents as JSON Lines files."""
    out = scratch_dir(lk.spark, "s05-payloads")
    FD.fixture_docs(lk.partidas).select("payload").write.text(out)
    return J.flatten_fixtures(FS.read_payloads(lk.spark, out, whole_file=False).select("payload"))


register("s05_payload_lines", q(f"""
SELECT partida_id, rodada, data, {_HORA} AS hora,
       CASE WHEN status = 'finished' THEN 'FT' ELSE 'NS' END AS status, arena, mandante, visitante,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT) AS mandante_id,
       CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT) AS visitante_id, gols_mandante, gols_visitante
FROM partidas"""))(_payload_lines)


def _landed_twice(lk):
    """The same files landed twice are there once."""
    src, dest = (scratch_dir(lk.spark, n) for n in ("s06-source", "s06-bronze"))
    lk.partidas.select(F.concat_ws(";", "partida_id", "mandante")).write.text(src)
    FS.land_raw(lk.spark, src, dest)
    return (FS.land_raw(lk.spark, src, dest).select(F.explode(F.split("conteudo", "\n")).alias("linha"))
            .filter(F.col("linha") != ""))


register("s06_landed_twice", q("SELECT partida_id || ';' || mandante AS linha FROM partidas"))(_landed_twice)


def _stacked_seasons(lk):
    """Yearly sheets of different width stacked by column name."""
    p = lk.partidas.select("partida_id", "temporada", "mandante", "arena")
    return FS.union_seasons([p.filter(F.col("temporada") < SEASON).drop("arena"), p.filter(F.col("temporada") >= SEASON)])


register("s07_stacked_seasons", q(f"""
SELECT partida_id, temporada, mandante, CASE WHEN temporada >= {SEASON} THEN arena END AS arena FROM partidas"""))(
    _stacked_seasons)


def _season_overwritten(lk):
    """K1/K2: writing one season again replaces that season only."""
    path = scratch_dir(lk.spark, "k02-table")
    p = lk.partidas.select("partida_id", "temporada", "mandante", "gols_mandante")
    write_table(p, path, partition_by=["temporada"])
    write_table(p.filter(F.col("temporada") == SEASON).withColumn("gols_mandante", F.col("gols_mandante") + 10), path,
                partition_by=["temporada"])
    return lk.spark.read.parquet(path)


register("k02_season_overwritten", q(f"""
SELECT partida_id, temporada, mandante, gols_mandante + CASE WHEN temporada = {SEASON} THEN 10 ELSE 0 END AS gols_mandante
FROM partidas"""))(_season_overwritten)


def _exported(lk):
    """K3: JSON Lines export in order, dates as ISO text."""
    path = scratch_dir(lk.spark, "k03-json")
    rows = lk.partidas.select("partida_id", "data", "mandante", "gols_mandante")
    export_json(rows, path, order=["partida_id"])
    return lk.spark.read.schema(rows.schema).json(path)


register("k03_exported_json", q("SELECT partida_id, data, mandante, gols_mandante FROM partidas"))(_exported)


def _published(lk):
    """K4: gold tables copied to the serving folder."""
    dest = scratch_dir(lk.spark, "k04-serving")
    publish({"desempenho_clubes": gold_of(lk)["desempenho_clubes"]}, dest)
    return lk.spark.read.parquet(f"{dest}/desempenho_clubes")


register("k04_published", q("SELECT * FROM desempenho_clubes"))(_published)


def _served_view(lk):
    """V6: gold tables and served views by name, asked in SQL."""
    create_views({n: df for n, df in gold_of(lk).items() if not n.startswith("v_")})
    return FS.run_sql(lk.spark, "SELECT temporada, clube FROM v_campeoes")


register("v06_served_view", q("SELECT temporada, clube FROM v_campeoes"))(_served_view)
