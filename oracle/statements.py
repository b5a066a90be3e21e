"""DuckDB SQL per query name."""

from __future__ import annotations

import re

from oracle.views import (AGENCIES, BAND, EXPLORE_FLOOR, FLOOR, KEY_PLANNED, PERIOD, VIEWS, band_label,
                          expanded, observed, reliability_score, seconds, travel_score,
                          wrapped_minutes)


def _needed(sql: str, found: dict[str, None]) -> None:
    """Collect the views a statement reads, each after the views it reads itself."""
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found.setdefault(name)


def _statement(sql: str) -> str:
    """Prepend the common table expressions a statement needs, in dependency order."""
    found: dict[str, None] = {}
    _needed(sql, found)
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in found)
    return f"WITH {views}\n{sql}"


def _best(view: str, group: str, order: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {group}
            ORDER BY {order}) AS rn FROM {view}) z WHERE rn = 1"""


def _by_bucket(bucket: str, value: str) -> str:
    label = "numero AS hora" if bucket == "hora" else f"{band_label('numero')} AS \"SubFaixa15\""
    return f"SELECT {label}, servico, {value} FROM shares WHERE faixa = '{bucket}'"


def _containment(name: str, left: str, right: str, keys: str) -> str:
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    inner = f"(SELECT count(*) FROM {left} a JOIN {right} b ON {on})"
    left_only = f"(SELECT count(*) FROM {left} a WHERE NOT EXISTS (SELECT 1 FROM {right} b WHERE {on}))"
    right_only = f"(SELECT count(*) FROM {right} b WHERE NOT EXISTS (SELECT 1 FROM {left} a WHERE {on}))"
    return f"""
        SELECT '{name}' AS join_name, {inner} AS inner_rows, {left_only} AS left_only_rows,
            {right_only} AS right_only_rows, {inner} + {left_only} AS left_rows,
            {inner} + {right_only} AS right_rows"""


def _quality(column: str) -> str:
    return f"""
        SELECT '{column}' AS coluna, count(*) AS linhas,
            count(*) FILTER (WHERE {column} IS NULL) AS nulos,
            count(*) FILTER (WHERE {column} <> rtrim({column})) AS brancos_no_fim,
            count(*) FILTER (WHERE {column} IS NOT NULL
                AND TRY_CAST({column} AS BIGINT) IS NULL) AS nao_inteiros
        FROM fx_viagem_completa"""


_TEXTS = {
    "trips": "feed_version route_id service_id trip_id trip_headsign trip_short_name direction_id "
             "shape_id versao_modelo",
    "frequencies": "feed_version trip_id start_time end_time exact_times versao_modelo",
    "routes": "feed_version route_id agency_id route_short_name versao_modelo",
    "agency": "agency_id agency_name feed_version versao_modelo",
    "feed_info": "feed_version feed_publisher_name feed_publisher_url feed_lang default_lang "
                 "feed_contact_email feed_contact_url versao_modelo",
    "calendar": "tipo_dia subtipo_dia tipo_os feed_version versao",
    "realised": "consorcio tipo_dia id_empresa id_veiculo id_viagem servico_informado "
                "servico_realizado vista trip_id shape_id sentido tipo_viagem versao_modelo",
}
_OTHERS = {
    "trips": "feed_start_date feed_end_date", "frequencies": "feed_start_date feed_end_date headway_secs",
    "routes": "feed_start_date feed_end_date", "agency": "feed_start_date",
    "feed_info": "feed_start_date feed_end_date feed_update_datetime",
    "calendar": "data service_ids feed_start_date datetime_ultima_atualizacao",
    "realised": "data datetime_partida datetime_chegada inicio_periodo fim_periodo tempo_viagem "
                "tempo_planejado distancia_planejada distancia_aferida n_registros_shape "
                "n_registros_total n_registros_minuto velocidade_media perc_conformidade_shape "
                "perc_conformidade_distancia perc_conformidade_registros perc_conformidade_tempo "
                "datetime_ultima_atualizacao",
}
_FX = {"trips": "fx_trips", "frequencies": "fx_frequencies", "routes": "fx_routes", "agency": "fx_agency",
       "calendar": "fx_calendario", "realised": "fx_viagem_completa",
       "feed_info": "(SELECT *, NULL::VARCHAR AS feed_publisher_name, NULL::VARCHAR AS feed_publisher_url, "
                    "NULL::VARCHAR AS feed_lang, NULL::VARCHAR AS default_lang, "
                    "NULL::VARCHAR AS feed_contact_email, NULL::VARCHAR AS feed_contact_url, "
                    "CAST(feed_start_date AS TIMESTAMP) AS feed_update_datetime FROM fx_feed_info)"}


def _column_counts(table: str, column: str, text: bool) -> str:
    counts = (f"""count(*) FILTER (WHERE {column} = '') AS vazios,
            count(*) FILTER (WHERE {column} <> rtrim({column})) AS brancos_no_fim,
            count(*) FILTER (WHERE {column} IS NOT NULL
                AND TRY_CAST({column} AS BIGINT) IS NULL) AS nao_inteiros""" if text else
              "0::BIGINT AS vazios, 0::BIGINT AS brancos_no_fim, 0::BIGINT AS nao_inteiros")
    return f"""
        SELECT '{table}' AS tabela, '{column}' AS coluna, count(*) AS linhas,
            count(*) FILTER (WHERE {column} IS NULL) AS nulos, {counts}
        FROM {_FX[table]} x"""


_SIDE_VR = "consorcio, trip_id, sentido, servico_realizado, datetime_partida_VR, datetime_chegada_VR, tempo_viagem_VR"
_SIDE_VP = _SIDE_VR.replace("_VR", "_VP")
_PAIR_TIMES = ("datetime_partida_VP, datetime_partida_VR, datetime_chegada_VP, datetime_chegada_VR, "
               "tempo_viagem_VP, tempo_viagem_VR")
_PAIR_ORDER = f"segundos, contador, {_PAIR_TIMES}"
_ONE_TO_ONE = f"""
        SELECT * FROM (WITH RECURSIVE candidates_1 AS (
            SELECT vr.consorcio, vr.trip_id, vr.sentido, vr.servico_realizado,
                vp.datetime_partida AS datetime_partida_VP, vr.datetime_partida AS datetime_partida_VR,
                vp.datetime_chegada AS datetime_chegada_VP, vr.datetime_chegada AS datetime_chegada_VR,
                vp.tempo_viagem AS tempo_viagem_VP, vr.tempo_viagem AS tempo_viagem_VR,
                abs(date_diff('second', vr.datetime_partida, vp.datetime_partida)) AS segundos,
                min(abs(vr.viagens_consecutivas - vp.viagens_consecutivas)) AS contador
            FROM observed vr JOIN planned vp
                ON vp.consorcio = vr.consorcio AND vp.trip_id = vr.trip_id
                AND vp.sentido = vr.sentido AND vp.servico_realizado = vr.servico_realizado
                AND vp.tempo_viagem > 0 AND vr.tempo_viagem > 0
                AND vp.datetime_partida BETWEEN vr.datetime_partida
                        - to_minutes(CAST(round(vr.tempo_viagem * 0.25::DOUBLE) AS BIGINT))
                    AND vr.datetime_partida
                        + to_minutes(CAST(round(vr.tempo_viagem * 0.25::DOUBLE) AS BIGINT))
                AND abs(vr.viagens_consecutivas - vp.viagens_consecutivas) <= 5
            GROUP BY ALL),
        proposals AS (
            SELECT *, 0 AS state FROM candidates_1
            UNION ALL
            SELECT * EXCLUDE (hit, gone_p, gone_r), CASE WHEN hit THEN 1 ELSE 0 END AS state FROM (
                SELECT *, bool_or(hit) OVER (PARTITION BY {_SIDE_VP}) AS gone_p,
                    bool_or(hit) OVER (PARTITION BY {_SIDE_VR}) AS gone_r
                FROM (SELECT * EXCLUDE (state),
                        row_number() OVER (PARTITION BY {_SIDE_VP} ORDER BY {_PAIR_ORDER}) = 1
                        AND row_number() OVER (PARTITION BY {_SIDE_VR} ORDER BY {_PAIR_ORDER}) = 1 AS hit
                      FROM proposals WHERE state = 0) h) g
            WHERE hit OR NOT (gone_p OR gone_r))
        SELECT consorcio, trip_id, sentido, servico_realizado, {_PAIR_TIMES}
        FROM proposals WHERE state = 1) z"""


def _of_week(view: str) -> str:
    """A view of the regularity chain over the second week of the month."""
    return re.sub(r"\b(regular|shares|score_parts|totals|placed)\b", r"\1_week", VIEWS[view])


_WEEK = f"""
        SELECT * FROM (WITH regular_week AS (
            SELECT * FROM regular
            WHERE CAST(data_partida AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'),
        {", ".join(f"{v}_week AS ({_of_week(v)})" for v in ("shares", "score_parts", "totals", "placed"))}
        SELECT posicao, servico, round(unit * 100, 3) AS score FROM placed_week) z"""

_BANDED = f"(SELECT *, {BAND.format('data_partida')} AS band FROM trip)"
_HOURLY = "(SELECT *, hour(data_partida) AS hora FROM regular)"
_RANKED = "SELECT posicao, servico, round(indicador, 6) AS indicador FROM ranking"
_QUARTER_COLUMNS = (f"servico, round(score, 6) AS score, data_partida, "
                    f"{band_label('band')} AS \"SubFaixa15\"")
_RAW_WINDOWS = f"""
    FROM (SELECT * FROM fx_trips WHERE feed_version >= {FLOOR}
            AND feed_start_date IN (SELECT feed_start_date FROM feeds)) t
    JOIN (SELECT * FROM fx_frequencies WHERE feed_version >= {FLOOR}
            AND feed_start_date IN (SELECT feed_start_date FROM feeds)) f
        USING (feed_version, feed_start_date, feed_end_date, trip_id, versao_modelo)
    JOIN route_rows r ON t.feed_version = r.feed_version
        AND t.feed_start_date = r.feed_start_date AND t.route_id = r.route_id
        AND t.versao_modelo = r.versao_modelo
    JOIN s_calendar_rows c ON t.feed_version = c.feed_version
        AND t.feed_start_date = c.feed_start_date AND t.service_id = c.service_id
    WHERE trim(r.route_short_name) = trim(t.trip_short_name)
        AND {wrapped_minutes('f.start_time', 'f.end_time')} > 0"""

# Joined timetable rows of all feed versions, without the agency.
_UNFLOORED = f"""
    SELECT c.data, t.service_id, t.trip_headsign, t.trip_id, t.shape_id,
        CASE t.direction_id WHEN '0' THEN 'I' WHEN '1' THEN 'V' ELSE 'C' END AS sentido,
        {seconds('f.start_time')} AS start_seconds, {seconds('f.end_time')} AS end_seconds,
        t.route_id, t.trip_short_name, c.tipo_os,
        CAST(round(f.headway_secs / 60.0::DOUBLE) AS BIGINT) AS headway,
        t.feed_version, t.feed_start_date, t.feed_end_date, t.versao_modelo
    FROM fx_trips t
    JOIN fx_frequencies f USING (feed_version, feed_start_date, feed_end_date, trip_id,
                                 versao_modelo)
    JOIN fx_routes r ON t.feed_version = r.feed_version AND t.feed_start_date = r.feed_start_date
        AND t.route_id = r.route_id AND t.versao_modelo = r.versao_modelo
    JOIN (SELECT k.*, x.service_id FROM fx_calendario k,
              LATERAL (SELECT unnest(k.service_ids) AS service_id) x WHERE k.data {PERIOD}) c
        ON t.feed_version = c.feed_version AND t.feed_start_date = c.feed_start_date
        AND t.service_id = c.service_id
    WHERE trim(r.route_short_name) = trim(t.trip_short_name)
        AND {wrapped_minutes('f.start_time', 'f.end_time')} > 0"""

_STATEMENTS = {
    # scans and sources
    "scan_trips": "SELECT * FROM s_trips",
    "scan_frequencies": "SELECT * FROM s_frequencies",
    "scan_routes_agency": "SELECT * FROM s_routes",
    "scan_calendar": "SELECT * FROM s_calendar",
    "scan_realised": f"SELECT * FROM fx_viagem_completa WHERE data {PERIOD} AND tempo_viagem > 0",
    "explore_agency": f"""
        SELECT DISTINCT agency_id FROM fx_agency
        WHERE agency_name IN {AGENCIES} AND feed_start_date {PERIOD}""",
    "explore_calendar": f"""
        SELECT c.data, c.tipo_dia, c.tipo_os, x.service_id, c.feed_version, c.feed_start_date,
            f.feed_end_date
        FROM fx_calendario c, LATERAL (SELECT unnest(c.service_ids) AS service_id) x
        JOIN fx_feed_info f ON c.feed_version = f.feed_version
            AND c.feed_start_date = f.feed_start_date
        WHERE c.feed_version >= {FLOOR} AND c.data {PERIOD}""",
    "explore_service_ids": f"""
        SELECT DISTINCT trim(x.service_id) AS service_ids
        FROM fx_calendario c, LATERAL (SELECT unnest(c.service_ids) AS service_id) x
        WHERE c.data {PERIOD}""",
    "explore_subtipo_dia": f"""
        SELECT DISTINCT subtipo_dia FROM fx_calendario
        WHERE data {PERIOD} AND subtipo_dia IS NOT NULL""",
    "explore_frequencies": f"""
        SELECT feed_version, feed_start_date, feed_end_date, trip_id, start_time, end_time,
            headway_secs, exact_times
        FROM fx_frequencies WHERE feed_version >= {EXPLORE_FLOOR}""",
    "explore_routes": f"SELECT * FROM fx_routes WHERE feed_start_date {PERIOD}",
    "explore_trips": f"""
        SELECT feed_version, feed_start_date, feed_end_date, route_id, service_id, trip_id,
            trip_headsign, trip_short_name, direction_id
        FROM fx_trips WHERE feed_version >= {EXPLORE_FLOOR}""",
    "explore_trips_realised": f"""
        SELECT t.trip_id, t.route_id, t.service_id, t.feed_version, t.feed_start_date,
            t.feed_end_date
        FROM fx_trips t JOIN fx_viagem_completa v ON v.trip_id = t.trip_id
        WHERE v.data {PERIOD} AND t.service_id IN ('D', 'D_REG', 'EXCEP', 'S_REG', 'U_REG')""",
    "explore_realised": f"SELECT * FROM fx_viagem_completa WHERE data {PERIOD}",
    "source_csv_cache": "SELECT * FROM matched",
    "sink_csv_cache": "SELECT * FROM matched",
    "sink_ranking_csv": "SELECT posicao, servico, round(unit * 100, 3) AS score FROM placed",
    # projections and filters
    "active_feeds": "SELECT * FROM feeds",
    "active_service_ids": f"""
        SELECT array_to_string(list_sort(list(DISTINCT x.service_id)), ',') AS service_ids
        FROM fx_calendario c, LATERAL (SELECT unnest(c.service_ids) AS service_id) x
        WHERE c.feed_version >= {FLOOR} AND c.data {PERIOD}""",
    "filter_feed_floor": f"SELECT * FROM fx_trips WHERE feed_version >= {FLOOR}",
    "filter_feed_membership": """
        SELECT feed_version, feed_start_date, route_id, agency_id FROM fx_routes
        WHERE feed_start_date IN (SELECT feed_start_date FROM feeds)""",
    "filter_date_between": f"""
        SELECT data, id_viagem, tempo_viagem FROM fx_viagem_completa WHERE data {PERIOD}""",
    "filter_trim_eq": """
        SELECT t.feed_version, t.route_id, t.trip_id, r.route_short_name, t.trip_short_name
        FROM s_trips t JOIN s_routes r USING (feed_version, feed_start_date, route_id,
                                              versao_modelo)
        WHERE trim(r.route_short_name) = trim(t.trip_short_name)""",
    "filter_positive_duration": f"""
        SELECT feed_version, trip_id, {wrapped_minutes('start_time', 'end_time')} AS tempo_viagem,
            CAST(round(headway_secs / 60.0::DOUBLE) AS BIGINT) AS headway
        FROM s_frequencies WHERE {wrapped_minutes('start_time', 'end_time')} > 0""",
    "filter_not_null_pair": """
        SELECT * FROM paired WHERE tempo_viagem_VP IS NOT NULL AND tempo_viagem_VR IS NOT NULL""",
    "direction_code": """
        SELECT feed_version, trip_id, direction_id, CASE direction_id WHEN '0' THEN 'I'
            WHEN '1' THEN 'V' ELSE 'C' END AS sentido
        FROM fx_trips""",
    "select_rename": "SELECT * FROM renamed",
    "cast_types": "SELECT * FROM matched",
    "cast_types_rejects": """
        SELECT 'tempo_viagem_VR' AS coluna, 'x' || tempo_viagem_VR AS valor, count(*) AS linhas
        FROM matched WHERE minute(datetime_partida_VR) % 7 = 0 GROUP BY ALL
        UNION ALL
        SELECT 'datetime_partida_VP', 'sem hora', count(*)
        FROM matched WHERE minute(datetime_partida_VR) % 11 = 0 HAVING count(*) > 0""",
    "final_projection": "SELECT servico, round(score, 6) AS score, data_partida FROM regular",
    "filter_service_lookup": """
        SELECT ' ' || n.nome || ' ' AS servico, round(coalesce(r.indicador, -1), 6) AS indicador
        FROM (SELECT DISTINCT trim(trip_short_name) AS nome FROM fx_trips) n
        LEFT JOIN ranking r ON trim(r.servico) = n.nome""",
    # joins
    "join_trips_frequencies": "SELECT * FROM services",
    "join_left_agency": "SELECT * FROM route_rows",
    "join_right_routes": """
        SELECT r.feed_version, r.route_id, s.trip_id, s.start_time, r.agency_name,
            r.route_short_name
        FROM services s RIGHT JOIN s_routes r USING (feed_version, feed_start_date, route_id,
                                                     versao_modelo)""",
    "join_calendar": """
        SELECT c.data, c.tipo_os, s.service_id, s.feed_version, s.trip_id, s.start_time,
            s.end_time
        FROM services s JOIN s_calendar c USING (feed_version, feed_start_date, service_id)""",
    "join_feed_range": """
        SELECT data, id_viagem, inicio_periodo, fim_periodo, feed_version, feed_start_date,
            feed_end_date
        FROM realised_feeds""",
    "join_band_match": "SELECT * FROM matched",
    "join_band_match_departures": "SELECT * FROM matched",
    "join_band_match_plain": "SELECT * FROM matched",
    "join_band_match_left": "SELECT * FROM paired",
    "join_band_match_bucketed": "SELECT * FROM matched",
    "associate_one_to_one": _ONE_TO_ONE,
    "join_weights": """
        SELECT faixa, numero, servico, viagens, total_viagens, round(peso, 6) AS peso
        FROM shares""",
    "join_score_parts": """
        SELECT servico, round(score_hora, 6) AS score_hora,
            round(score_subfaixa15, 6) AS score_subfaixa15
        FROM score_parts""",
    "unnest_cross": """
        SELECT c.data, c.feed_version, x.service_id
        FROM fx_calendario c, LATERAL (SELECT unnest(c.service_ids) AS service_id) x""",
    "audit_join_containment": " UNION ALL ".join([
        _containment("trips_frequencies", "s_trips", "s_frequencies",
                     "feed_version, feed_start_date, feed_end_date, trip_id, versao_modelo"),
        _containment("trips_routes", "services", "s_routes",
                     "feed_version, feed_start_date, route_id, versao_modelo"),
        _containment("trips_calendar", "services", "s_calendar",
                     "feed_version, feed_start_date, service_id")]),
    # aggregations
    "distinct_rows": "SELECT DISTINCT * FROM fx_routes",
    "array_agg_distinct": """
        SELECT array_to_string(list_sort(list(DISTINCT CAST(feed_start_date AS VARCHAR))), ',')
            AS feeds
        FROM feeds""",
    "hourly_trip_counts": "SELECT * FROM hour_counts",
    "service_mean": "SELECT servico, round(score, 6) AS score FROM means",
    "hour_service_mean": "SELECT hora, servico, round(score, 6) AS score FROM hour_means",
    "hour_share_weight": _by_bucket("hora", "round(peso, 6) AS peso"),
    "quarter_share_weight": _by_bucket("SubFaixa15", "round(peso, 6) AS peso"),
    "hour_regularity": _by_bucket("hora", "round(media * peso, 6) AS score"),
    "hour_regularity_worst": _by_bucket("hora", "round(media * peso, 6) AS score"),
    "quarter_regularity": _by_bucket("SubFaixa15", "round(media * peso, 6) AS score"),
    "quarter_regularity_best": _by_bucket("SubFaixa15", "round(media * peso, 6) AS score"),
    "regularity_rollup": """
        SELECT servico, round(avg(media * peso), 6) AS score, faixa FROM shares
        GROUP BY servico, faixa""",
    "regularity_sum": "SELECT posicao, servico, round(score, 6) AS score FROM placed",
    "minmax_normalise": "SELECT servico, round(score, 6) AS score, data_partida FROM trip",
    "audit_duplicates": f"""
        SELECT (SELECT count(*) {_RAW_WINDOWS}) AS linhas,
            (SELECT count(*) FROM windows) AS linhas_distintas,
            round((SELECT count(*) {_RAW_WINDOWS})::DOUBLE
                / (SELECT count(*) FROM windows)::DOUBLE, 6) AS razao""",
    "audit_feed_floor_sweep": f"""
        SELECT * FROM (WITH raw AS ({_UNFLOORED})
        SELECT feed_version, brutas, linhas,
            CAST(sum(brutas) OVER (ORDER BY feed_version DESC) AS BIGINT) AS brutas_com_piso,
            CAST(sum(linhas) OVER (ORDER BY feed_version DESC) AS BIGINT) AS linhas_com_piso
        FROM (SELECT feed_version, count(*) AS brutas FROM raw GROUP BY ALL) a
        JOIN (SELECT feed_version, count(*) AS linhas FROM (SELECT DISTINCT * FROM raw) d
              GROUP BY ALL) b USING (feed_version)) q""",
    "audit_feed_match": f"""
        SELECT * FROM (WITH trips AS (
            SELECT row_number() OVER () AS n, * FROM fx_viagem_completa
            WHERE data {PERIOD} AND tempo_viagem > 0),
        found AS (
            SELECT n, count(f.feed_version) AS feeds,
                coalesce(bool_or(trim(v.versao_modelo) = trim(f.versao_modelo)), false) AS same
            FROM trips v LEFT JOIN fx_feed_info f ON f.feed_version >= {FLOOR}
                AND v.inicio_periodo >= f.feed_start_date AND v.fim_periodo <= f.feed_end_date
            GROUP BY n)
        SELECT count(*) AS viagens, count_if(feeds = 0)::BIGINT AS em_nenhum_feed,
            count_if(feeds = 1)::BIGINT AS em_um_feed, count_if(feeds > 1)::BIGINT AS em_varios_feeds,
            coalesce(sum(feeds), 0)::BIGINT AS linhas, count_if(same)::BIGINT AS com_modelo_igual
        FROM found) q""",
    "audit_match_yield": """
        SELECT * FROM (WITH done AS (
            SELECT DISTINCT servico_realizado AS servico, datetime_partida AS partida,
                datetime_chegada AS chegada, tempo_viagem AS tempo FROM observed),
        pairs AS (
            SELECT service_VR AS servico, datetime_partida_VR AS partida,
                datetime_chegada_VR AS chegada, tempo_viagem_VR AS tempo, count(*) AS n
            FROM matched GROUP BY ALL)
        SELECT CAST(partida AS DATE) AS data, servico, count(*) AS viagens,
            count(n) AS viagens_associadas, coalesce(sum(n), 0)::BIGINT AS pares
        FROM done LEFT JOIN pairs USING (servico, partida, chegada, tempo) GROUP BY 1, 2) q""",
    "audit_column_quality": " UNION ALL ".join(
        _quality(c) for c in ("id_empresa", "id_veiculo", "servico_informado",
                              "servico_realizado", "versao_modelo")),
    "audit_table_quality": " UNION ALL ".join(
        _column_counts(table, column, names is _TEXTS)
        for names in (_TEXTS, _OTHERS) for table, columns in names.items()
        for column in columns.split()),
    # windows
    "planned_sequence": "SELECT * FROM planned",
    "planned_sequence_by_trip": f"""
        SELECT DISTINCT row_id, consorcio, data, tipo_dia, {KEY_PLANNED} AS id_viagem,
            servico_realizado, vista, trip_id, shape_id, sentido, datetime_partida,
            datetime_chegada, tempo_viagem, feed_version, feed_start_date, versao_modelo
        FROM generated_by_trip""",
    "planned_month_departures": f"""
        SELECT DISTINCT consorcio, data, tipo_dia, {KEY_PLANNED} AS id_viagem,
            servico_realizado, vista, trip_id, shape_id, sentido, datetime_partida,
            datetime_chegada, tempo_viagem, feed_version, feed_start_date, versao_modelo
        FROM generated_by_trip""",
    "realised_sequence": "SELECT * FROM observed",
    "realised_sequence_by_service": f"""
        SELECT row_number() OVER (
                PARTITION BY consorcio, servico_realizado, trip_id, shape_id, sentido
                ORDER BY data, datetime_partida, id_viagem, tipo_dia, versao_modelo NULLS FIRST,
                    vista, datetime_chegada, inicio_periodo, fim_periodo, tempo_viagem,
                    feed_version, feed_start_date, feed_end_date) AS viagens_consecutivas, *
        FROM ({observed('tipo_dia, versao_modelo,')}) o""",
    "rank_position": """
        SELECT row_number() OVER (ORDER BY score DESC NULLS LAST, servico) AS posicao, servico,
            round(score, 6) AS score
        FROM (SELECT servico, round(avg(score), 10) AS score FROM regular
            WHERE servico IS NOT NULL GROUP BY servico) z""",
    "positional_halves": "SELECT * FROM halves",
    "lag_lead_gap": """
        SELECT hora, viagens, metade, least(
            abs(hora - lag(hora, 1, 0) OVER (PARTITION BY metade ORDER BY hora)),
            abs(hora - lead(hora, 1, 0) OVER (PARTITION BY metade ORDER BY hora))) AS intervalo
        FROM halves""",
    "argmax_per_group": _best(_HOURLY, "hora", "score DESC, data_partida, servico",
                              "hora, data_partida, servico, round(score, 6) AS score"),
    # rankings
    "service_ranking": _RANKED,
    "ranking_top10": f"{_RANKED} ORDER BY posicao LIMIT 10",
    "ranking_bottom10": f"{_RANKED} ORDER BY posicao DESC LIMIT 10",
    "best_service_per_hour": _best("hour_means", "hora", "score DESC, servico",
                                   "hora, servico, round(score, 6) AS score"),
    "worst_service_per_hour": _best("hour_means", "hora", "score, servico",
                                    "hora, servico, round(score, 6) AS score"),
    "rush_hours": "SELECT hora, viagens FROM rush_halves",
    "best_service_rush_hour": _best(
        "hour_means", "hora", "score DESC, servico", "hora, servico, round(score, 6) AS score")
        + " AND hora IN (SELECT hora FROM rush_halves)",
    "worst_service_rush_hour": _best(
        "hour_means", "hora", "score, servico", "hora, servico, round(score, 6) AS score")
        + " AND hora IN (SELECT hora FROM rush_halves)",
    "best_trip_per_quarter": _best(_BANDED, "band", "score DESC, data_partida, servico",
                                   _QUARTER_COLUMNS),
    "worst_trip_per_quarter": _best(_BANDED, "band", "score, data_partida, servico",
                                    _QUARTER_COLUMNS),
    "final_ranking": "SELECT posicao, servico, round(unit * 100, 3) AS score FROM placed",
    "final_ranking_from_totals": "SELECT posicao, servico, round(unit * 100, 3) AS score FROM placed",
    "week_ranking_from_totals": _WEEK,
    "band_totals_by_day": f"""
        SELECT CAST(data_partida AS DATE) AS dia, {BAND.format('data_partida')} AS banda, servico,
            count(*) AS viagens, round(sum(score), 6) AS soma, count(score) AS validas
        FROM regular WHERE servico IS NOT NULL GROUP BY ALL""",
    "union_rush": "SELECT metade, hora, viagens FROM rush_halves",
    # scalar rules over whole tables
    "parse_hms": """
        SELECT feed_version, trip_id, start_time,
            TRY_CAST(split_part(start_time, ':', 1) AS BIGINT) AS horas,
            TRY_CAST(split_part(start_time, ':', 2) AS BIGINT) AS minutos,
            TRY_CAST(split_part(start_time, ':', 3) AS BIGINT) AS segundos
        FROM fx_frequencies""",
    "extended_time_departure": f"""
        SELECT c.data, s.feed_version, s.trip_id, s.start_time,
            CAST(c.data AS TIMESTAMP) + to_seconds({seconds('s.start_time')}) AS datetime_partida
        FROM services s JOIN (SELECT DISTINCT data, feed_version, feed_start_date, service_id
            FROM s_calendar_rows) c USING (feed_version, feed_start_date, service_id)""",
    "wrapped_duration_min": f"""
        SELECT feed_version, trip_id, start_time, end_time,
            {wrapped_minutes('start_time', 'end_time')} AS tempo_viagem
        FROM fx_frequencies""",
    "window_end": """
        SELECT data, trip_id, datetime_partida, datetime_chegada, tempo_viagem FROM windows""",
    "headway_minutes": """
        SELECT feed_version, trip_id, start_time, headway_secs,
            CAST(round(headway_secs / 60.0::DOUBLE) AS BIGINT) AS headway
        FROM fx_frequencies""",
    "departure_count": """
        SELECT data, trip_id, datetime_partida, tempo_viagem, headway,
            CAST(round(CAST(tempo_viagem AS DOUBLE) / nullif(headway, 0)) AS BIGINT) AS partidas
        FROM windows""",
    "expand_departures": "SELECT data, trip_id, datetime_partida, headway, i FROM expanded",
    "generated_departure": "SELECT data, trip_id, row_id, datetime_partida FROM generated",
    "generated_arrival": "SELECT data, trip_id, row_id, datetime_chegada FROM generated",
    "trip_key_planned": "SELECT trip_id, id_viagem FROM planned",
    "trip_key_realised": """
        SELECT id_viagem AS id_completo,
            substr(id_viagem, strpos(id_viagem, '-') + 1) AS id_viagem
        FROM fx_viagem_completa""",
    "date_cast": """
        SELECT id_viagem, CAST(inicio_periodo AS DATE) AS inicio, CAST(fim_periodo AS DATE) AS fim
        FROM fx_viagem_completa""",
    "score_travel_time": f"""
        SELECT id_viagem, tempo_viagem, {travel_score('tempo_viagem')} AS score
        FROM fx_viagem_completa""",
    "score_reliability": f"""
        SELECT "servico_VP", "datetime_partida_VP", "datetime_partida_VR",
            {reliability_score('datetime_partida_VR', 'datetime_partida_VP')} AS score
        FROM matched""",
    "score_departure_arrival": """
        SELECT servico, partida_planejada, partida_realizada, score_partida_chegada FROM parts""",
    "score_travel_delta": """
        SELECT servico, tempo_viagem_planejada, tempo_viagem_realizada, score_viagem
        FROM parts""",
    "score_weighted": """
        SELECT servico, partida_planejada, partida_realizada, round(score, 6) AS score
        FROM weighted""",
    "score_error_factor": """
        SELECT servico, tempo_viagem_planejada, tempo_viagem_realizada, round(fator, 6) AS fator
        FROM parts""",
    "hour_bucket": """
        SELECT id_viagem, datetime_partida, hour(datetime_partida) AS hora
        FROM fx_viagem_completa""",
    "quarter_hour_bucket": f"""
        SELECT id_viagem, datetime_partida,
            {band_label(BAND.format('datetime_partida'))} AS "SubFaixa15"
        FROM fx_viagem_completa""",
    "round_score": "SELECT servico, data_partida, round(score * 100, 3) AS score FROM trip",
}

ORACLE_SQL = {name: _statement(sql) for name, sql in _STATEMENTS.items()}
