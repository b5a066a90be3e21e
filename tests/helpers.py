"""Small hand-made inputs for the tests."""

from __future__ import annotations

from datetime import date, datetime

from pontualis import schemas
from pontualis.config import AnalysisConfig
from pontualis.sources.tables import TransitTables

CFG = AnalysisConfig(start_date=date(2024, 12, 1), end_date=date(2024, 12, 31),
                     feed_floor="2024-11-06")
FEED = ("2024-12-01", date(2024, 12, 1), date(2024, 12, 31))


def ts(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def frame(spark, schema, rows):
    """Rows given as dicts; missing columns are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def trip(trip_id="006-I-U", service="U_REG", line="006", direction="0", route="R6", **over):
    return dict(feed_version=FEED[0], feed_start_date=FEED[1], feed_end_date=FEED[2],
                route_id=route, service_id=service, trip_id=trip_id, trip_headsign="Centro",
                trip_short_name=line, direction_id=direction, shape_id="S6",
                versao_modelo="m") | over


def frequency(start, end, secs, trip_id="006-I-U", **over):
    return dict(feed_version=FEED[0], feed_start_date=FEED[1], feed_end_date=FEED[2],
                trip_id=trip_id, start_time=start, end_time=end, headway_secs=secs,
                versao_modelo="m") | over


def route(route_id="R6", agency="A1", line="006 ", **over):
    return dict(feed_version=FEED[0], feed_start_date=FEED[1], feed_end_date=FEED[2],
                route_id=route_id, agency_id=agency, route_short_name=line,
                versao_modelo="m") | over


def agency(agency_id="A1", name="Intersul", **over):
    return dict(agency_id=agency_id, agency_name=name, feed_version=FEED[0],
                feed_start_date=FEED[1], versao_modelo="m") | over


def feed(**over):
    return dict(feed_version=FEED[0], feed_start_date=FEED[1], feed_end_date=FEED[2],
                versao_modelo="m") | over


def day(data, services, **over):
    return dict(data=data, tipo_dia="Dia Util", tipo_os="Regular", service_ids=services,
                feed_version=FEED[0], feed_start_date=FEED[1], versao="v",
                datetime_ultima_atualizacao=ts("2024-12-01 00:00:00")) | over


def realised(departure, minutes, trip_id="006-I-U", line="006", consorcio="Intersul",
             sentido="I", key=None, **over):
    start = ts(departure)
    midnight = datetime(start.year, start.month, start.day)
    return dict(consorcio=consorcio, data=start.date(), tipo_dia="Dia Util",
                id_viagem=key or f"V1-{line}-{sentido}-{departure}", servico_realizado=line,
                vista="Centro", trip_id=trip_id, shape_id="S6", sentido=sentido,
                datetime_partida=start, datetime_chegada=start, inicio_periodo=midnight,
                fim_periodo=midnight, tempo_viagem=minutes) | over


def tables(spark, trips=(), frequencies=(), routes=(), agencies=(), feeds=(), days=(), trips_done=()):
    return TransitTables(
        trips=frame(spark, schemas.TRIPS, trips),
        frequencies=frame(spark, schemas.FREQUENCIES, frequencies),
        routes=frame(spark, schemas.ROUTES, routes),
        agency=frame(spark, schemas.AGENCY, agencies),
        feed_info=frame(spark, schemas.FEED_INFO, feeds),
        calendar=frame(spark, schemas.CALENDAR, days),
        realised=frame(spark, schemas.REALISED, trips_done))
