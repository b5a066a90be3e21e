"""Common table expressions of the oracle SQL: source tables and pipeline steps.

Written for DuckDB over the star tables, independently of the Spark code: the
planned departures are expanded first and numbered afterwards, and the match
is a plain band join.
"""

FLOOR = "'2024-01-01'"
EXPLORE_FLOOR = "'2023-01-01'"
PERIOD = "BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"
AGENCIES = "('Internorte', 'Intersul', 'Santa Cruz', 'Transcarioca')"

DAY_TYPE = "CASE dayofweek({0}) WHEN 0 THEN 'D_REG' WHEN 6 THEN 'S_REG' ELSE 'U_REG' END"


def seconds(text: str) -> str:
    parts = [f"TRY_CAST(split_part({text}, ':', {k}) AS BIGINT)" for k in (1, 2, 3)]
    return f"({parts[0]} * 3600 + {parts[1]} * 60 + {parts[2]})"


def wrapped_minutes(start: str, end: str) -> str:
    return f"(({seconds(end)} % 86400) // 60 - ({seconds(start)} % 86400) // 60)"


def travel_score(minutes: str) -> str:
    return (f"(CASE WHEN abs({minutes}) > 80 THEN 0.0::DOUBLE WHEN abs({minutes}) > 50 THEN 0.25 "
            f"WHEN abs({minutes}) > 20 THEN 0.5 WHEN abs({minutes}) > 13 THEN 1.0 "
            f"WHEN abs({minutes}) > 7 THEN 1.25 ELSE 1.5 END)::DOUBLE")


def reliability_score(later: str, earlier: str) -> str:
    m = f"round_even((epoch({later}) - epoch({earlier})) / 60.0::DOUBLE, 0)"
    return (f"(CASE WHEN {m} < -12 OR {m} > 20 THEN 0.0::DOUBLE "
            f"WHEN {m} < -9 OR {m} > 15 THEN 0.25 WHEN {m} < -3 OR {m} > 5 THEN 0.5 "
            f"ELSE 1.0 END)::DOUBLE")


def band_label(band: str) -> str:
    return (f"printf('%02d:%02d:00 - %02d:%02d:00', ({band}) // 4, (({band}) % 4) * 15, "
            f"((({band}) + 1) % 96) // 4, ((({band}) + 1) % 4) * 15)")


BAND = "((hour({0}) * 60 + minute({0})) // 15)"

SOURCES = {
    "fx_feed_info": """
        SELECT * FROM (VALUES
            ('2023-12-01', DATE '2023-12-01', DATE '2023-12-31', 'm1'),
            ('2024-01-01', DATE '2024-01-01', DATE '2024-01-15', 'm1'),
            ('2024-01-16', DATE '2024-01-16', DATE '2024-01-31', 'm1'))
        f(feed_version, feed_start_date, feed_end_date, versao_modelo)""",
    "fx_agency": """
        SELECT 'A' || CAST(r_regionkey AS VARCHAR) AS agency_id,
            CASE r_regionkey WHEN 0 THEN 'Internorte' WHEN 1 THEN 'Intersul'
                WHEN 2 THEN 'Santa Cruz' WHEN 3 THEN 'Transcarioca' ELSE 'Other' END
                AS agency_name,
            feed_version, feed_start_date, versao_modelo
        FROM region CROSS JOIN fx_feed_info""",
    "fx_routes": """
        SELECT feed_version, feed_start_date, feed_end_date,
            'R' || CAST(s_suppkey AS VARCHAR) AS route_id,
            'A' || CAST(s_nationkey % 5 AS VARCHAR) AS agency_id,
            lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')
                || CASE WHEN s_suppkey % 7 = 0 THEN '  ' ELSE '' END AS route_short_name,
            versao_modelo
        FROM supplier CROSS JOIN fx_feed_info CROSS JOIN (VALUES (0), (1)) dup(k)
        WHERE k = 0 OR s_suppkey % 3 = 0""",
    "fx_trips": """
        SELECT feed_version, feed_start_date, feed_end_date,
            'R' || CAST(s_suppkey AS VARCHAR) AS route_id, service_id,
            lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') || '-' || sentido || '-' || service_id
                AS trip_id,
            'Vista ' || CAST(s_suppkey AS VARCHAR) AS trip_headsign,
            lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS trip_short_name, direction_id,
            'S' || CAST(s_suppkey AS VARCHAR) || sentido AS shape_id, versao_modelo
        FROM supplier CROSS JOIN fx_feed_info
        CROSS JOIN (VALUES ('0', 'I'), ('1', 'V')) d(direction_id, sentido)
        CROSS JOIN (VALUES ('U_REG'), ('S_REG'), ('D_REG'), ('EXCEP')) q(service_id)""",
    "fx_frequencies": """
        SELECT feed_version, feed_start_date, feed_end_date, trip_id, start_time, end_time,
            CAST((10 + 5 * (CAST(substr(route_id, 2) AS BIGINT) % 4)) * 60 AS BIGINT) * hz
                + 20 * (1 - hz) AS headway_secs,
            '0' AS exact_times, versao_modelo
        FROM fx_trips CROSS JOIN (VALUES
            ('05:00:00', '08:00:00', 1), ('08:00:00', '11:10:00', 1),
            ('16:00:00', '19:00:00', 1), ('19:00:00', '19:02:00', 1),
            ('20:00:00', '21:00:00', 0), ('22:00:00', '25:00:00', 1),
            ('24:00:00', '26:00:00', 1)) w(start_time, end_time, hz)""",
    "fx_calendario": f"""
        SELECT data, {DAY_TYPE.format('data')} AS tipo_dia,
            CASE WHEN day(data) % 10 = 0 THEN 'Verao' END AS subtipo_dia,
            CASE WHEN day(data) % 10 = 0 THEN 'Extraordinaria' ELSE 'Regular' END AS tipo_os,
            CASE WHEN day(data) % 10 = 0
                THEN [{DAY_TYPE.format('data')}, 'EXCEP', 'EXCEP ']
                ELSE [{DAY_TYPE.format('data')}] END AS service_ids,
            CASE WHEN data < DATE '2024-01-16' THEN '2024-01-01' ELSE '2024-01-16' END
                AS feed_version,
            CASE WHEN data < DATE '2024-01-16' THEN DATE '2024-01-01'
                ELSE DATE '2024-01-16' END AS feed_start_date,
            'm1' AS versao, CAST(data AS TIMESTAMP) + INTERVAL 1 DAY
                AS datetime_ultima_atualizacao
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS data FROM events) z
        UNION ALL
        SELECT DISTINCT CAST(ts AS DATE), {DAY_TYPE.format('CAST(ts AS DATE)')}, NULL, 'Regular',
            [{DAY_TYPE.format('CAST(ts AS DATE)')}], '2023-12-01', DATE '2023-12-01', 'm1',
            CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
        FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-06')""",
    "fx_viagem_completa": f"""
        SELECT consorcio, data, tipo AS tipo_dia,
            CASE WHEN event_id % 40 = 0 THEN 'E' || CAST(s_suppkey AS VARCHAR)
                ELSE CAST(1000 + s_nationkey AS VARCHAR) END AS id_empresa,
            'V' || CAST(user_id AS VARCHAR) AS id_veiculo,
            'V' || CAST(user_id AS VARCHAR) || '-' || servico || '-' || sentido || '-'
                || shape_id || '-' || strftime(partida, '%Y%m%d%H%M%S') AS id_viagem,
            CASE WHEN event_id % 33 <> 0 THEN servico END AS servico_informado,
            servico AS servico_realizado, 'Vista' AS vista,
            servico || '-' || sentido || '-' || tipo AS trip_id, shape_id, sentido,
            partida AS datetime_partida,
            partida + to_minutes(CAST(tempo AS BIGINT)) AS datetime_chegada,
            CAST(data AS TIMESTAMP) AS inicio_periodo,
            CASE WHEN event_id % 50 = 0 THEN CAST(data AS TIMESTAMP) + to_minutes(1439)
                ELSE CAST(data AS TIMESTAMP) END AS fim_periodo,
            CASE WHEN event_id % 9 = 0 THEN 'Completa linha incorreta'
                ELSE 'Completa linha correta' END AS tipo_viagem,
            CAST(tempo AS BIGINT) AS tempo_viagem,
            CAST(10 + s_suppkey % 60 AS BIGINT) AS tempo_planejado,
            5 + CAST(s_suppkey % 20 AS DOUBLE) / 2 AS distancia_planejada,
            value AS distancia_aferida,
            CAST(event_id % 100 AS BIGINT) AS n_registros_shape,
            CAST(event_id % 100 + 5 AS BIGINT) AS n_registros_total,
            CAST(event_id % 60 AS BIGINT) AS n_registros_minuto,
            10 + CAST(event_id % 80 AS DOUBLE) / 4 AS velocidade_media,
            CAST(event_id % 101 AS DOUBLE) AS perc_conformidade_shape,
            CAST(event_id % 97 AS DOUBLE) AS perc_conformidade_distancia,
            CAST(event_id % 89 AS DOUBLE) AS perc_conformidade_registros,
            CAST(event_id % 120 AS BIGINT) AS perc_conformidade_tempo,
            CASE event_id % 3 WHEN 1 THEN 'm1  ' WHEN 2 THEN 'm1' END AS versao_modelo,
            CAST(data AS TIMESTAMP) + INTERVAL 1 DAY AS datetime_ultima_atualizacao
        FROM (SELECT e.event_id, e.user_id, e.value, CAST(e.ts AS DATE) AS data,
                CAST(date_trunc('second', ts) AS TIMESTAMP) AS partida,
                CASE WHEN e.event_id % 97 = 0 THEN 0 ELSE 10 + e.event_id % 80 END AS tempo,
                CASE WHEN e.event_id % 2 = 0 THEN 'I' ELSE 'V' END AS sentido,
                sp.servico, sp.s_suppkey, sp.s_nationkey,
                'S' || CAST(s_suppkey AS VARCHAR)
                    || CASE WHEN e.event_id % 2 = 0 THEN 'I' ELSE 'V' END AS shape_id,
                sp.consorcio, {DAY_TYPE.format('CAST(e.ts AS DATE)')} AS tipo
            FROM events e JOIN (
                SELECT s_suppkey, s_nationkey, lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')
                        AS servico,
                    CASE s_nationkey % 5 WHEN 0 THEN 'Internorte' WHEN 1 THEN 'Intersul'
                        WHEN 2 THEN 'Santa Cruz' WHEN 3 THEN 'Transcarioca' END AS consorcio,
                    row_number() OVER (ORDER BY s_suppkey) - 1 AS rn, count(*) OVER () AS n
                FROM supplier) sp ON e.user_id % sp.n = sp.rn) v""",
}

WINDOW_ORDER = ("feed_version, tempo_viagem, headway, data, consorcio NULLS FIRST, vista, "
                "shape_id, sentido, datetime_chegada, route_id, trip_short_name, tipo_os, "
                "feed_start_date, feed_end_date, versao_modelo")

OBSERVED_REST = ("data, servico_realizado, vista, trip_id, shape_id, sentido, datetime_chegada, "
                 "inicio_periodo, fim_periodo, tempo_viagem, feed_version, feed_start_date, "
                 "feed_end_date")


def windows(calendar_columns: str, type_columns: str) -> str:
    start = "CAST(c.data AS TIMESTAMP) + to_seconds(" + seconds("f.start_time") + ")"
    span = f"({seconds('f.end_time')} % 86400 - {seconds('f.start_time')} % 86400)"
    return f"""
        SELECT DISTINCT * FROM (
            SELECT c.data, r.agency_name AS consorcio, {type_columns}
                t.service_id AS servico_realizado, t.trip_headsign AS vista, t.trip_id,
                t.shape_id,
                CASE t.direction_id WHEN '0' THEN 'I' WHEN '1' THEN 'V' ELSE 'C' END AS sentido,
                {start} AS datetime_partida,
                {start} + to_seconds({span}) AS datetime_chegada,
                {wrapped_minutes('f.start_time', 'f.end_time')} AS tempo_viagem,
                t.route_id, t.trip_short_name, c.tipo_os,
                CAST(round(f.headway_secs / 60.0::DOUBLE) AS BIGINT) AS headway,
                t.feed_version, t.feed_start_date, t.feed_end_date, t.versao_modelo
            FROM s_trips t
            JOIN s_frequencies f USING (feed_version, feed_start_date, feed_end_date, trip_id,
                                        versao_modelo)
            RIGHT JOIN s_routes r ON t.feed_version = r.feed_version
                AND t.feed_start_date = r.feed_start_date AND t.route_id = r.route_id
                AND t.versao_modelo = r.versao_modelo
            JOIN (SELECT DISTINCT {calendar_columns}, data, service_id, feed_version,
                      feed_start_date FROM s_calendar_rows) c
                ON t.feed_version = c.feed_version AND t.feed_start_date = c.feed_start_date
                AND t.service_id = c.service_id
            WHERE t.feed_version >= {FLOOR}
                AND trim(r.route_short_name) = trim(t.trip_short_name)) w
        WHERE tempo_viagem > 0"""


def expanded(view: str) -> str:
    return f"""
        SELECT w.*, y.i FROM (SELECT *, CAST(round(CAST(tempo_viagem AS DOUBLE)
                / nullif(headway, 0)) AS BIGINT) AS partidas FROM {view}) w,
            LATERAL (SELECT unnest(generate_series(1, w.partidas)) AS i) y"""


def numbered(view: str, keys: str, order: str, extra: str = "") -> str:
    return f"""
        SELECT row_id, consorcio, data, {extra} trip_short_name AS servico_realizado, vista,
            trip_id, shape_id, sentido,
            datetime_partida + to_minutes(headway * row_id) AS datetime_partida,
            datetime_partida + to_minutes(headway * (row_id + 1)) AS datetime_chegada,
            tempo_viagem, feed_version, feed_start_date, versao_modelo
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}, i) AS row_id
              FROM {view}) n"""


KEY_PLANNED = ("servico_realizado || '-' || sentido || '-' || shape_id || '-' || "
               "strftime(datetime_partida, '%Y%m%d%H%M%S')")


def observed(extra: str = "") -> str:
    return f"""
        SELECT DISTINCT consorcio, data, {extra}
            substr(id_viagem, strpos(id_viagem, '-') + 1) AS id_viagem, servico_realizado, vista,
            trip_id, shape_id, sentido, datetime_partida, datetime_chegada,
            CAST(inicio_periodo AS DATE) AS inicio_periodo,
            CAST(fim_periodo AS DATE) AS fim_periodo, tempo_viagem, feed_version,
            feed_start_date, feed_end_date
        FROM realised_feeds"""


STEPS = {
    "feeds": f"""
        SELECT DISTINCT feed_start_date FROM fx_calendario
        WHERE feed_version >= {FLOOR} AND data {PERIOD}""",
    "s_trips": f"""
        SELECT DISTINCT feed_version, feed_start_date, feed_end_date, route_id, service_id,
            trip_id, trip_headsign, trip_short_name, direction_id, shape_id, versao_modelo
        FROM fx_trips WHERE feed_version >= {FLOOR}
            AND feed_start_date IN (SELECT feed_start_date FROM feeds)""",
    "s_frequencies": f"""
        SELECT DISTINCT feed_version, feed_start_date, feed_end_date, trip_id, start_time,
            end_time, headway_secs, versao_modelo
        FROM fx_frequencies WHERE feed_version >= {FLOOR}
            AND feed_start_date IN (SELECT feed_start_date FROM feeds)""",
    "route_rows": f"""
        SELECT r.feed_version, r.feed_start_date, r.feed_end_date, r.route_id, r.agency_id,
            a.agency_name, r.route_short_name, r.versao_modelo
        FROM fx_routes r LEFT JOIN (SELECT DISTINCT agency_id, agency_name, versao_modelo
                FROM fx_agency WHERE feed_version >= {FLOOR} AND agency_name IN {AGENCIES}) a
            ON r.agency_id = a.agency_id AND r.versao_modelo = a.versao_modelo
        WHERE r.feed_version >= {FLOOR}
            AND r.feed_start_date IN (SELECT feed_start_date FROM feeds)""",
    "s_routes": "SELECT DISTINCT * FROM route_rows",
    "s_calendar_rows": f"""
        SELECT c.*, x.service_id
        FROM fx_calendario c, LATERAL (SELECT unnest(c.service_ids) AS service_id) x
        WHERE c.feed_version >= {FLOOR} AND c.data {PERIOD}
            AND c.feed_start_date IN (SELECT feed_start_date FROM feeds)""",
    "s_calendar": """
        SELECT DISTINCT data, tipo_os, service_id, feed_version, feed_start_date,
            versao AS versao_modelo, datetime_ultima_atualizacao
        FROM s_calendar_rows""",
    "services": """
        SELECT * FROM s_trips JOIN s_frequencies
            USING (feed_version, feed_start_date, feed_end_date, trip_id, versao_modelo)""",
    "windows": windows("tipo_os", ""),
    "windows_alone": windows("tipo_dia, subtipo_dia AS tipo_os", "c.tipo_dia,"),
    "expanded": expanded("windows"),
    "generated": numbered("expanded", "trip_id, datetime_partida, servico_realizado",
                          WINDOW_ORDER),
    "planned": f"""
        SELECT DISTINCT row_id AS viagens_consecutivas, consorcio, data,
            {KEY_PLANNED} AS id_viagem, servico_realizado, vista, trip_id, shape_id, sentido,
            datetime_partida, datetime_chegada, tempo_viagem, feed_version, feed_start_date
        FROM generated""",
    "generated_by_trip": numbered(
        f"({expanded('windows_alone')}) e", "trip_id",
        "datetime_partida, tempo_viagem, feed_version, headway, data, "
        "consorcio NULLS FIRST, tipo_dia, servico_realizado, vista, shape_id, sentido, "
        "datetime_chegada, route_id, trip_short_name, tipo_os NULLS FIRST, feed_start_date, "
        "feed_end_date, versao_modelo", "tipo_dia,"),
    "realised_feeds": f"""
        SELECT v.*, f.feed_version, f.feed_start_date, f.feed_end_date
        FROM fx_viagem_completa v JOIN fx_feed_info f ON f.feed_version >= {FLOOR}
            AND v.inicio_periodo >= f.feed_start_date AND v.fim_periodo <= f.feed_end_date
        WHERE v.data {PERIOD} AND v.tempo_viagem > 0""",
    "observed_rows": observed(),
    "observed": f"""
        SELECT row_number() OVER (PARTITION BY data, trip_id, servico_realizado
                ORDER BY datetime_partida, id_viagem, consorcio NULLS FIRST, {OBSERVED_REST})
                AS viagens_consecutivas, *
        FROM observed_rows""",
    "paired": """
        SELECT DISTINCT vp.servico_realizado AS servico_VP, vr.servico_realizado AS service_VR,
            vp.datetime_partida AS datetime_partida_VP, vr.datetime_partida AS datetime_partida_VR,
            vp.datetime_chegada AS datetime_chegada_VP, vr.datetime_chegada AS datetime_chegada_VR,
            vp.tempo_viagem AS tempo_viagem_VP, vr.tempo_viagem AS tempo_viagem_VR
        FROM observed vr LEFT JOIN planned vp
            ON vp.consorcio = vr.consorcio AND vp.trip_id = vr.trip_id
            AND vp.sentido = vr.sentido AND vp.servico_realizado = vr.servico_realizado
            AND vp.tempo_viagem > 0 AND vr.tempo_viagem > 0
            AND vp.datetime_partida BETWEEN
                vr.datetime_partida - to_minutes(CAST(round(vr.tempo_viagem * 0.25::DOUBLE) AS BIGINT))
                AND vr.datetime_partida
                    + to_minutes(CAST(round(vr.tempo_viagem * 0.25::DOUBLE) AS BIGINT))
            AND abs(vr.viagens_consecutivas - vp.viagens_consecutivas) <= 5""",
    "matched": """
        SELECT * FROM paired WHERE tempo_viagem_VP IS NOT NULL AND tempo_viagem_VR IS NOT NULL""",
    "renamed": """
        SELECT servico_VP AS servico, datetime_partida_VP AS partida_planejada,
            datetime_partida_VR AS partida_realizada, datetime_chegada_VP AS chegada_planejada,
            datetime_chegada_VR AS chegada_realizada, tempo_viagem_VP AS tempo_viagem_planejada,
            tempo_viagem_VR AS tempo_viagem_realizada
        FROM matched""",
    "parts": f"""
        SELECT *, {reliability_score('partida_realizada', 'partida_planejada')}
                + {reliability_score('chegada_realizada', 'chegada_planejada')}
                AS score_partida_chegada,
            CASE WHEN {travel_score('tempo_viagem_realizada')}
                    = {travel_score('tempo_viagem_planejada')} THEN 1.0::DOUBLE
                ELSE {travel_score('tempo_viagem_realizada')}
                    - {travel_score('tempo_viagem_planejada')} END AS score_viagem,
            1.0::DOUBLE - abs(tempo_viagem_realizada - tempo_viagem_planejada)::DOUBLE
                / nullif(tempo_viagem_realizada + tempo_viagem_planejada, 0)::DOUBLE AS fator
        FROM renamed""",
    "weighted": """
        SELECT *, score_partida_chegada * (8::DOUBLE / 14) + score_viagem * (2::DOUBLE / 14)
            AS score
        FROM parts""",
    "regular": """
        SELECT servico, score, partida_realizada AS data_partida FROM weighted""",
    "trip": """
        SELECT servico, (raw - low) / nullif(high - low, 0) AS score, data_partida
        FROM (SELECT servico, score * fator AS raw, partida_realizada AS data_partida,
                min(score * fator) OVER () AS low, max(score * fator) OVER () AS high
            FROM weighted) z""",
    "shares": f"""
        SELECT faixa, numero, servico, viagens,
            CAST(sum(viagens) OVER (PARTITION BY faixa, numero) AS BIGINT) AS total_viagens,
            viagens / sum(viagens) OVER (PARTITION BY faixa, numero)::DOUBLE AS peso, media
        FROM (SELECT 'hora' AS faixa, hour(data_partida) AS numero, servico,
                count(*) AS viagens, avg(score) AS media
            FROM regular WHERE servico IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT 'SubFaixa15', {BAND.format('data_partida')}, servico, count(*), avg(score)
            FROM regular WHERE servico IS NOT NULL GROUP BY ALL) z""",
    "score_parts": """
        SELECT servico, avg(CASE WHEN faixa = 'hora' THEN media * peso END) AS score_hora,
            avg(CASE WHEN faixa = 'SubFaixa15' THEN media * peso END) AS score_subfaixa15
        FROM shares GROUP BY servico""",
    "totals": """
        SELECT servico, round(score_hora + score_subfaixa15, 10) AS score FROM score_parts""",
    "placed": """
        SELECT row_number() OVER (ORDER BY score DESC NULLS LAST, servico) AS posicao, servico,
            score, (score - min(score) OVER ()) / nullif(max(score) OVER () - min(score) OVER (), 0)
                AS unit
        FROM totals""",
    "means": """
        SELECT servico, round(avg(score), 10) AS score FROM trip
        WHERE servico IS NOT NULL GROUP BY servico""",
    "ranking": """
        SELECT row_number() OVER (ORDER BY score DESC NULLS LAST, servico) AS posicao, servico,
            score AS indicador
        FROM means""",
    "hour_means": """
        SELECT hour(data_partida) AS hora, servico, round(avg(score), 10) AS score FROM trip
        WHERE servico IS NOT NULL GROUP BY ALL""",
    "hour_counts": """
        SELECT hour(data_partida) AS hora, count(*) AS viagens FROM regular GROUP BY ALL""",
    "halves": """
        SELECT hora, viagens, CASE WHEN row_number() OVER (ORDER BY hora) <= 12 THEN 'manha'
            ELSE 'tarde' END AS metade
        FROM hour_counts""",
    "busy": """
        SELECT * FROM halves
        WHERE viagens >= (SELECT avg(viagens) FROM hour_counts) * 0.75::DOUBLE""",
    "candidates": """
        SELECT metade, hora, viagens FROM (
            SELECT *, avg(viagens) OVER (PARTITION BY metade)
                + stddev_samp(viagens) OVER (PARTITION BY metade) * 0.5::DOUBLE AS level
            FROM busy) z
        WHERE viagens >= level""",
    "rush_halves": """
        SELECT metade, hora, viagens FROM (
            SELECT *, row_number() OVER (PARTITION BY metade, gap ORDER BY viagens DESC, hora)
                AS rn
            FROM (SELECT *, least(
                    abs(hora - lag(hora, 1, 0) OVER (PARTITION BY metade ORDER BY hora)),
                    abs(hora - lead(hora, 1, 0) OVER (PARTITION BY metade ORDER BY hora))) AS gap
                FROM candidates) g) r
        WHERE rn = 1""",
}

VIEWS = {**SOURCES, **STEPS}
