"""Explicit schemas of the source tables and of the tables written by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "date": T.DateType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """Schema of ``name type`` pairs; usable before a session exists."""
    pairs = (pair.split() for pair in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TRIPS = _schema("""
    feed_version string, feed_start_date date, feed_end_date date, route_id string,
    service_id string, trip_id string, trip_headsign string, trip_short_name string,
    direction_id string, shape_id string, versao_modelo string
""")

FREQUENCIES = _schema("""
    feed_version string, feed_start_date date, feed_end_date date, trip_id string,
    start_time string, end_time string, headway_secs bigint, exact_times string,
    versao_modelo string
""")

ROUTES = _schema("""
    feed_version string, feed_start_date date, feed_end_date date, route_id string,
    agency_id string, route_short_name string, versao_modelo string
""")

AGENCY = _schema("""
    agency_id string, agency_name string, feed_version string, feed_start_date date,
    versao_modelo string
""")

FEED_INFO = _schema("""
    feed_version string, feed_start_date date, feed_end_date date,
    feed_publisher_name string, feed_publisher_url string, feed_lang string,
    default_lang string, feed_contact_email string, feed_contact_url string,
    feed_update_datetime timestamp_ntz, versao_modelo string
""")

CALENDAR = _schema("""
    data date, tipo_dia string, subtipo_dia string, tipo_os string,
    service_ids array<string>, feed_version string, feed_start_date date,
    versao string, datetime_ultima_atualizacao timestamp_ntz
""")

REALISED = _schema("""
    consorcio string, data date, tipo_dia string, id_empresa string, id_veiculo string,
    id_viagem string, servico_informado string, servico_realizado string, vista string,
    trip_id string, shape_id string, sentido string, datetime_partida timestamp_ntz,
    datetime_chegada timestamp_ntz, inicio_periodo timestamp_ntz,
    fim_periodo timestamp_ntz, tipo_viagem string, tempo_viagem bigint,
    tempo_planejado bigint, distancia_planejada double, distancia_aferida double,
    n_registros_shape bigint, n_registros_total bigint, n_registros_minuto bigint,
    velocidade_media double, perc_conformidade_shape double,
    perc_conformidade_distancia double, perc_conformidade_registros double,
    perc_conformidade_tempo bigint, versao_modelo string,
    datetime_ultima_atualizacao timestamp_ntz
""")

MATCHED = _schema("""
    servico_VP string, service_VR string,
    datetime_partida_VP timestamp_ntz, datetime_partida_VR timestamp_ntz,
    datetime_chegada_VP timestamp_ntz, datetime_chegada_VR timestamp_ntz,
    tempo_viagem_VP bigint, tempo_viagem_VR bigint
""")

SCORED = _schema("servico string, score double, data_partida timestamp_ntz")

BAND_TOTALS = _schema("banda bigint, servico string, viagens bigint, soma double, validas bigint")

DAY_MANIFEST = _schema("versao string, linhas bigint, dia date")

RANKING = _schema("posicao bigint, servico string, score double")

# Columns of the star schema that the derived transit tables read.
STAR_EVENTS = _schema("event_id bigint, ts timestamp_ntz, user_id bigint, value double")
STAR_SUPPLIER = _schema("s_suppkey bigint, s_nationkey int")
STAR_REGION = _schema("r_regionkey int")
