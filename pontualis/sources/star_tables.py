"""Transit tables derived from a generic star schema with an event stream.

Suppliers become bus lines, regions agencies and events realised trips, so the
queries can run, and grow, on data that holds no timetable of its own.  Only
``events``, ``supplier`` and ``region`` are read.  Constant lists (feeds,
directions, day types, frequency windows) are inlined from array literals.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pontualis import schemas
from pontualis.config import AnalysisConfig
from pontualis.operators.numbering import number_rows

STAR_CONFIG = AnalysisConfig(
    start_date=date(2024, 1, 1), end_date=date(2024, 1, 30), feed_floor="2024-01-01",
    explore_floor="2023-01-01")


def _list(columns: str, *rows: str) -> str:
    """LATERAL VIEW over a literal list of rows."""
    alias = columns.replace(" ", "").replace(",", "_")
    return f"LATERAL VIEW inline(array({', '.join(f'struct({r})' for r in rows)})) {alias} AS {columns}"


# The first feed lies before the feed floor.
_FEEDS = _list(
    "feed_version, feed_start_date, feed_end_date, versao_modelo",
    "'2023-12-01', date'2023-12-01', date'2023-12-31', 'm1'",
    "'2024-01-01', date'2024-01-01', date'2024-01-15', 'm1'",
    "'2024-01-16', date'2024-01-16', date'2024-01-31', 'm1'")

# Start, end and whether the headway is regular: a window shorter than a
# headway, one with a 20-second headway, one that wraps past midnight and one
# wholly after midnight are included.
_WINDOWS = _list(
    "start_time, end_time, regular", "'05:00:00', '08:00:00', 1L", "'08:00:00', '11:10:00', 1L",
    "'16:00:00', '19:00:00', 1L", "'19:00:00', '19:02:00', 1L", "'20:00:00', '21:00:00', 0L",
    "'22:00:00', '25:00:00', 1L", "'24:00:00', '26:00:00', 1L")

# Padded to four digits; longer numbers stay whole, as lpad would cut them.
_LINE = ("lpad(CAST(s_suppkey AS STRING), greatest(4, length(CAST(s_suppkey AS STRING))), '0')")
_DAY_TYPE = ("CASE dayofweek({0}) WHEN 1 THEN 'D_REG' WHEN 7 THEN 'S_REG' ELSE 'U_REG' END")
_SECONDS = "CAST(CAST(ts - timestamp_ntz'1970-01-01 00:00:00' AS INTERVAL SECOND) AS BIGINT)"

_AGENCY = f"""
    SELECT concat('A', CAST(r_regionkey AS STRING)) AS agency_id,
        CASE r_regionkey WHEN 0 THEN 'Internorte' WHEN 1 THEN 'Intersul'
            WHEN 2 THEN 'Santa Cruz' WHEN 3 THEN 'Transcarioca' ELSE 'Other' END AS agency_name,
        feed_version, feed_start_date, versao_modelo
    FROM {{region}} {_FEEDS}"""

_ROUTES = f"""
    SELECT feed_version, feed_start_date, feed_end_date,
        concat('R', CAST(s_suppkey AS STRING)) AS route_id,
        concat('A', CAST(s_nationkey % 5 AS STRING)) AS agency_id,
        concat({_LINE}, IF(s_suppkey % 7 = 0, '  ', '')) AS route_short_name, versao_modelo
    FROM {{supplier}} {_FEEDS} {_list('copy', '0', '1')}
    WHERE copy = 0 OR s_suppkey % 3 = 0"""

_TRIPS = f"""
    SELECT feed_version, feed_start_date, feed_end_date,
        concat('R', CAST(s_suppkey AS STRING)) AS route_id, service_id,
        concat_ws('-', {_LINE}, sentido, service_id) AS trip_id,
        concat('Vista ', CAST(s_suppkey AS STRING)) AS trip_headsign,
        {_LINE} AS trip_short_name, direction_id,
        concat('S', CAST(s_suppkey AS STRING), sentido) AS shape_id, versao_modelo
    FROM {{supplier}} {_FEEDS} {_list('direction_id, sentido', "'0', 'I'", "'1', 'V'")}
        {_list('service_id', "'U_REG'", "'S_REG'", "'D_REG'", "'EXCEP'")}"""

_FREQUENCIES = f"""
    SELECT feed_version, feed_start_date, feed_end_date, trip_id, start_time, end_time,
        IF(regular = 1, (10 + 5 * (CAST(substr(route_id, 2) AS BIGINT) % 4)) * 60, 20L)
            AS headway_secs,
        '0' AS exact_times, versao_modelo
    FROM {{trips}} {_WINDOWS}"""

_FEED_INFO = f"""
    SELECT feed_version, feed_start_date, feed_end_date,
        CAST(NULL AS STRING) AS feed_publisher_name, CAST(NULL AS STRING) AS feed_publisher_url,
        CAST(NULL AS STRING) AS feed_lang, CAST(NULL AS STRING) AS default_lang,
        CAST(NULL AS STRING) AS feed_contact_email, CAST(NULL AS STRING) AS feed_contact_url,
        CAST(feed_start_date AS TIMESTAMP_NTZ) AS feed_update_datetime, versao_modelo
    FROM VALUES (1) AS one(k) {_FEEDS}"""

_CALENDAR = f"""
    SELECT data, tipo_dia, IF(day(data) % 10 = 0, 'Verao', NULL) AS subtipo_dia,
        IF(day(data) % 10 = 0, 'Extraordinaria', 'Regular') AS tipo_os,
        IF(day(data) % 10 = 0, array(tipo_dia, 'EXCEP', 'EXCEP '), array(tipo_dia))
            AS service_ids,
        IF(data < date'2024-01-16', '2024-01-01', '2024-01-16') AS feed_version,
        IF(data < date'2024-01-16', date'2024-01-01', date'2024-01-16') AS feed_start_date,
        'm1' AS versao,
        CAST(data AS TIMESTAMP_NTZ) + INTERVAL '1' DAY AS datetime_ultima_atualizacao
    FROM (SELECT data, {_DAY_TYPE.format('data')} AS tipo_dia
          FROM (SELECT DISTINCT CAST(ts AS DATE) AS data FROM {{events}}))
    UNION ALL
    SELECT data, tipo_dia, CAST(NULL AS STRING), 'Regular', array(tipo_dia), '2023-12-01',
        date'2023-12-01', 'm1', CAST(data AS TIMESTAMP_NTZ) + INTERVAL '1' DAY
    FROM (SELECT data, {_DAY_TYPE.format('data')} AS tipo_dia
          FROM (SELECT DISTINCT CAST(ts AS DATE) AS data FROM {{events}})
          WHERE data IN (date'2024-01-03', date'2024-01-06'))"""

# An event runs on the line whose rank among all lines, from 0, is the user id
# modulo the number of lines.  Line numbers may have gaps.
_REALISED = f"""
    SELECT CASE s_nationkey % 5 WHEN 0 THEN 'Internorte' WHEN 1 THEN 'Intersul'
            WHEN 2 THEN 'Santa Cruz' WHEN 3 THEN 'Transcarioca' END AS consorcio,
        data, tipo_dia,
        IF(event_id % 40 = 0, concat('E', CAST(s_suppkey AS STRING)),
           CAST(1000 + s_nationkey AS STRING)) AS id_empresa,
        veiculo AS id_veiculo,
        concat_ws('-', veiculo, servico, sentido, shape_id,
            translate(CAST(partida AS STRING), '- :', '')) AS id_viagem,
        IF(event_id % 33 <> 0, servico, NULL) AS servico_informado,
        servico AS servico_realizado, 'Vista' AS vista,
        concat_ws('-', servico, sentido, tipo_dia) AS trip_id, shape_id, sentido,
        partida AS datetime_partida,
        partida + INTERVAL '1' MINUTE * tempo AS datetime_chegada,
        meia_noite AS inicio_periodo,
        IF(event_id % 50 = 0, meia_noite + INTERVAL '1439' MINUTE, meia_noite) AS fim_periodo,
        IF(event_id % 9 = 0, 'Completa linha incorreta', 'Completa linha correta')
            AS tipo_viagem,
        tempo AS tempo_viagem, 10 + s_suppkey % 60 AS tempo_planejado,
        5 + CAST(s_suppkey % 20 AS DOUBLE) / 2 AS distancia_planejada,
        value AS distancia_aferida, event_id % 100 AS n_registros_shape,
        event_id % 100 + 5 AS n_registros_total, event_id % 60 AS n_registros_minuto,
        10 + CAST(event_id % 80 AS DOUBLE) / 4 AS velocidade_media,
        CAST(event_id % 101 AS DOUBLE) AS perc_conformidade_shape,
        CAST(event_id % 97 AS DOUBLE) AS perc_conformidade_distancia,
        CAST(event_id % 89 AS DOUBLE) AS perc_conformidade_registros,
        event_id % 120 AS perc_conformidade_tempo,
        CASE event_id % 3 WHEN 1 THEN 'm1  ' WHEN 2 THEN 'm1' END AS versao_modelo,
        meia_noite + INTERVAL '1' DAY AS datetime_ultima_atualizacao
    FROM (
        SELECT e.event_id, e.value, s.s_suppkey, s.s_nationkey, data,
            {_DAY_TYPE.format('data')} AS tipo_dia, CAST(data AS TIMESTAMP_NTZ) AS meia_noite,
            concat('V', CAST(user_id AS STRING)) AS veiculo, {_LINE} AS servico, sentido,
            concat('S', CAST(s.s_suppkey AS STRING), sentido) AS shape_id,
            timestamp_ntz'1970-01-01 00:00:00' + INTERVAL '1' SECOND * segundos AS partida,
            IF(event_id % 97 = 0, 0L, 10 + event_id % 80) AS tempo
        FROM (SELECT event_id, user_id, value, CAST(ts AS DATE) AS data,
                  {_SECONDS} AS segundos, IF(event_id % 2 = 0, 'I', 'V') AS sentido,
                  user_id % (SELECT count(*) FROM {{supplier}}) AS line
              FROM {{events}}) e
        JOIN {{lines}} s ON e.line = s.rank - 1)"""

# Suppliers are ranked in cells of this many numbers, not in one sorted window.
_RANK_CELL = 4096

# A task multiplies at most about this many suppliers, by 168 for the frequencies.
_TASK_SUPPLIERS = 512


class StarTables:
    """The attributes of ``TransitTables``, each planned when it is first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder.rstrip("/")

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self._spark.read.schema(schema).parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        return self._read("events", schemas.STAR_EVENTS)

    @cached_property
    def _supplier(self) -> DataFrame:
        return self._read("supplier", schemas.STAR_SUPPLIER)

    @cached_property
    def _spread_supplier(self) -> DataFrame:
        """Suppliers over as many tasks as what becomes of them needs; their file may be one small split."""
        tasks = -(-self._supplier.count() // _TASK_SUPPLIERS)
        return self._supplier.repartition(tasks) if tasks > 1 else self._supplier

    @cached_property
    def trips(self) -> DataFrame:
        return self._spark.sql(_TRIPS, supplier=self._spread_supplier)

    @cached_property
    def frequencies(self) -> DataFrame:
        return self._spark.sql(_FREQUENCIES, trips=self.trips)

    @cached_property
    def routes(self) -> DataFrame:
        return self._spark.sql(_ROUTES, supplier=self._spread_supplier)

    @cached_property
    def agency(self) -> DataFrame:
        return self._spark.sql(_AGENCY, region=self._read("region", schemas.STAR_REGION))

    @cached_property
    def feed_info(self) -> DataFrame:
        return self._spark.sql(_FEED_INFO)

    @cached_property
    def calendar(self) -> DataFrame:
        return self._spark.sql(_CALENDAR, events=self._events)

    @cached_property
    def realised(self) -> DataFrame:
        lines = number_rows(self._supplier, [], F.floor(F.col("s_suppkey") / _RANK_CELL),
                            ["s_suppkey"], "rank")
        return self._spark.sql(_REALISED, events=self._events, supplier=self._supplier,
                               lines=lines)


def star_tables(spark: SparkSession, folder: str) -> StarTables:
    return StarTables(spark, folder)
