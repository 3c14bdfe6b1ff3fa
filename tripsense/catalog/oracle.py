"""The same results as plain SQL for an independent engine."""

from __future__ import annotations

from tripsense.catalog.fixtures import ORACLE_VIEWS

# What the results must hold, written down once more: a column or an edge lost in the library shows here.
_AGGREGATES = """
    AVG(speed) AS avg_speed, STDDEV_SAMP(speed) AS std_speed,
    AVG(accel_mag) AS avg_accel_mag, MAX(accel_mag) AS max_accel_mag, STDDEV_SAMP(accel_mag) AS std_accel_mag,
    AVG(gyro_mag) AS avg_gyro_mag, STDDEV_SAMP(gyro_mag) AS std_gyro_mag,
    AVG(acceleration_x) AS avg_accel_x, STDDEV_SAMP(acceleration_x) AS std_accel_x, MAX(acceleration_x) AS max_accel_x,
    AVG(acceleration_y) AS avg_accel_y, STDDEV_SAMP(acceleration_y) AS std_accel_y, MAX(acceleration_y) AS max_accel_y,
    AVG(acceleration_z) AS avg_accel_z, STDDEV_SAMP(acceleration_z) AS std_accel_z, MAX(acceleration_z) AS max_accel_z,
    AVG(gyro_x) AS avg_gyro_x, STDDEV_SAMP(gyro_x) AS std_gyro_x, AVG(gyro_y) AS avg_gyro_y,
    STDDEV_SAMP(gyro_y) AS std_gyro_y, AVG(gyro_z) AS avg_gyro_z, STDDEV_SAMP(gyro_z) AS std_gyro_z,
    AVG(accuracy) AS avg_accuracy, STDDEV_SAMP(accuracy) AS std_accuracy, MAX(second) AS second"""
_NAMES = [part.split()[-1] for part in _AGGREGATES.split(",")]
MODEL_FEATURES = (
    "std_gyro_z", "std_accel_y", "std_accel_z", "max_accel_x", "avg_speed", "std_accel_x", "max_accel_mag",
    "std_speed", "std_gyro_mag", "std_gyro_x", "max_accel_z", "avg_gyro_mag", "std_accel_mag", "second",
)
CARD_COLUMNS = (
    "avg_speed", "std_speed", "avg_accel_mag", "max_accel_mag", "std_accel_mag", "avg_gyro_mag", "std_gyro_mag",
)
RAW_CHANNELS = (
    "accuracy", "bearing", "acceleration_x", "acceleration_y", "acceleration_z", "gyro_x", "gyro_y", "gyro_z",
    "second", "speed",
)
SPEED_BUCKETS = (("0-5", 0, 5), ("5-10", 5, 10), ("10-15", 10, 15), ("15-20", 15, 20), ("20-25", 20, 25))
DURATION_BUCKETS = (
    ("Short trip (<10min)", 0, 600), ("Normal trip (10-30min)", 600, 1800), ("Long trip (>30min)", 1800, None),
)
SAFE_MESSAGE = "✅ Continue driving safely!"
DANGER_MESSAGE = "⚠️ You are driving too fast!"
SEED = 42
TRAIN_FRACTION = 0.7
CHUNK_ROWS = 20
LOOKUP_ID = 7
STD_SPEED_LIMIT = 8.0
DUP_ARRIVAL = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
_MAGNITUDES = (
    "SQRT(POWER(acceleration_x, 2) + POWER(acceleration_y, 2) + POWER(acceleration_z, 2)) AS accel_mag,"
    " SQRT(POWER(gyro_x, 2) + POWER(gyro_y, 2) + POWER(gyro_z, 2)) AS gyro_mag"
)


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded, and never minus zero."""
    return f"ROUND({expression}, {digits}) + 0e0 AS {name or expression}"


def _features_of(source: str) -> str:
    return f"SELECT bookingid, {_AGGREGATES} FROM (SELECT *, {_MAGNITUDES} FROM {source}) m GROUP BY bookingid"


_FILLED = ", ".join(f"COALESCE({name}, 0e0) AS {name}" for name in _NAMES)
_ROUNDED = ", ".join(r(name) for name in _NAMES)

_DERIVED = {
    **ORACLE_VIEWS,
    "once": "SELECT bookingid, MAX(label) AS label FROM fx_labels GROUP BY bookingid HAVING COUNT(*) = 1",
    "features": _features_of("fx_raw"),
    "labelled": "SELECT f.*, o.label FROM features f LEFT JOIN once o ON f.bookingid = o.bookingid",
    "trips": f"SELECT bookingid, {_FILLED}, COALESCE(label, 0) AS label FROM labelled",
    "ranked": "SELECT *, ROW_NUMBER() OVER (PARTITION BY bookingid ORDER BY seq) - 1 AS rn,"
              " COUNT(*) OVER (PARTITION BY bookingid) AS n FROM fx_stream",
    "spans": "SELECT bookingid, n, full_windows, UNNEST(RANGE(0, full_windows + 1)) AS window_idx FROM"
             " (SELECT DISTINCT bookingid, n, CASE WHEN n < 10 THEN 0 ELSE (n - 10) // 5 + 1 END AS full_windows"
             " FROM ranked) t",
    "windowed": f"SELECT s.window_idx, s.full_windows, k.*, {_MAGNITUDES} FROM spans s JOIN ranked k"
                " ON k.bookingid = s.bookingid AND k.rn >= 5 * s.window_idx"
                " AND (s.window_idx = s.full_windows OR k.rn < 5 * s.window_idx + 10)",
}
_NEEDS = {
    "fx_gaps": ["fx_raw"],
    "once": ["fx_labels"],
    "features": ["fx_raw"],
    "labelled": ["features", "once"],
    "trips": ["labelled"],
    "ranked": ["fx_stream"],
    "spans": ["ranked"],
    "windowed": ["spans", "ranked"],
}


def with_views(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    parts = [f"{name} AS ({_DERIVED[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _buckets(panel: str, column: str, buckets) -> str:
    listed = ", ".join(
        f"({position}, '{label}', {float(low)}, {'NULL' if high is None else float(high)})"
        for position, (label, low, high) in enumerate(buckets)
    )
    return (
        f"SELECT '{panel}' AS panel, b.position, b.bucket, COUNT(t.bookingid) AS trips"
        f" FROM (VALUES {listed}) b(position, bucket, low, high) LEFT JOIN trips t"
        f" ON t.{column} > b.low AND (b.high IS NULL OR t.{column} <= b.high) GROUP BY b.position, b.bucket"
    )


def _safety(source: str) -> str:
    return (
        "SELECT 'safety' AS panel, b.position, b.bucket, COUNT(t.bookingid) AS trips"
        f" FROM (VALUES (0, 'Safe', 0), (1, 'Dangerous', 1)) b(position, bucket, value) LEFT JOIN {source} t"
        " ON t.label = b.value GROUP BY b.position, b.bucket"
    )


_SPEED = _buckets("speed", "avg_speed", SPEED_BUCKETS)
_SPEED_STD = _buckets("speed_std", "std_speed", SPEED_BUCKETS)
_DURATION = _buckets("duration", "second", DURATION_BUCKETS)
_SPLIT_GAINS = f"""
SELECT feature, {r('threshold')}, CAST(nb AS BIGINT) AS rows_below, CAST(pb AS BIGINT) AS positives_below, {r('gain')}
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) AS place FROM (
    SELECT *, ROUND((2e0 * p * (n - p) / n - 2e0 * pb * (nb - pb) / nb
      - 2e0 * (p - pb) * (n - nb - p + pb) / (n - nb)) / n, 9) AS gain
    FROM (
      SELECT feature, low + bin * width AS threshold, SUM(c) OVER below AS nb, SUM(q) OVER below AS pb,
        SUM(c) OVER (PARTITION BY feature) AS n, SUM(q) OVER (PARTITION BY feature) AS p
      FROM (
        SELECT feature, low, width, LEAST(FLOOR((x - low) / width), 31) AS bin, COUNT(*) AS c, COUNT(*) FILTER (WHERE label = 1) AS q
        FROM (
          SELECT *, MIN(x) OVER (PARTITION BY feature) AS low,
            (MAX(x) OVER (PARTITION BY feature) - MIN(x) OVER (PARTITION BY feature)) / 32 AS width
          FROM (UNPIVOT (SELECT label, {_ROUNDED} FROM trips) ON {', '.join(_NAMES)} INTO NAME feature VALUE x) u
        ) m WHERE width > 0 GROUP BY feature, low, width, bin
      ) b WINDOW below AS (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ) s WHERE nb > 0
  ) g
) best WHERE place = 1"""
_BALANCED_SCAN = """
SELECT CAST(DENSE_RANK() OVER (ORDER BY place) AS INTEGER) AS range, 1 AS met, CAST(n AS BIGINT) AS rows FROM (
  SELECT place, SUM(n) AS n FROM (
    SELECT n, CAST((SUM(n) OVER (ORDER BY bookingid, inner_) - n) * 16 AS BIGINT) // SUM(n) OVER () AS place FROM (
      SELECT bookingid, CASE WHEN hot THEN second END AS inner_, COUNT(*) AS n FROM (
        SELECT bookingid, second, COUNT(*) OVER (PARTITION BY bookingid) * 16 > COUNT(*) OVER () AS hot FROM fx_raw
      ) s GROUP BY bookingid, inner_
    ) c
  ) p GROUP BY place
) ranges"""
_PANEL = "SELECT position, bucket, trips FROM ({}) p"

_RAW_ROUNDED = ", ".join(r(name) for name in RAW_CHANNELS)
_TRIPS_OUT = f"SELECT bookingid, {_ROUNDED}, label FROM trips"
_FIRST_WRITER = (
    "SELECT bookingid, second, {speed} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY bookingid, second ORDER BY"
    " {order}, speed) AS rn FROM fx_dup) t WHERE rn = 1"
)
_WINDOW_SUMMARY = (
    "SELECT bookingid, window_idx, COUNT(*) AS rows, COUNT(*) < 10 AS is_tail, MIN(seq) AS first_seq,"
    f" MAX(seq) AS last_seq, {r('AVG(speed)', 'avg_speed')}, {r('STDDEV_SAMP(speed)', 'std_speed')}"
    " FROM windowed {where} GROUP BY bookingid, window_idx"
)
_WINDOW_FEATURES = (
    f"SELECT bookingid, window_idx, COUNT(*) AS rows, COUNT(*) < 10 AS is_tail, {_AGGREGATES}"
    " FROM windowed {where} GROUP BY bookingid, window_idx"
)
_LATEST = (
    "SELECT bookingid,"
    f" {r('ARG_MAX(speed, seq) FILTER (WHERE speed <> 0)', 'speed')},"
    f" {r('ARG_MAX(time, seq) FILTER (WHERE time <> 0)', 'time')},"
    " ARG_MAX_NULL(label, seq) FILTER (WHERE has_label) AS label, MAX(seq) AS seq"
    " FROM fx_stream GROUP BY bookingid"
)


# Rules of the table by row; of rows that keep them, the first of each key by arrival is the one without a violation.
_ROUTED = (
    "SELECT bookingid, second, speed, CASE WHEN broken = '' AND ROW_NUMBER() OVER (PARTITION BY bookingid, second ORDER BY"
    f" broken <> '', {', '.join(DUP_ARRIVAL)}) > 1 THEN 'key' ELSE broken END AS violations FROM (SELECT {', '.join(DUP_ARRIVAL)},"
    " CASE WHEN l_suppkey % 7 = 0 OR l_suppkey % 11 = 0 THEN NULL ELSE bookingid END AS bookingid,"
    " CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE second END AS second,"
    " CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_partkey AS DOUBLE) END AS speed,"
    " CONCAT_WS(',', CASE WHEN l_suppkey % 7 = 0 THEN 'null:bookingid' END, CASE WHEN l_partkey % 13 = 0 THEN 'null:second' END,"
    " CASE WHEN l_suppkey % 7 <> 0 AND l_suppkey % 11 = 0 THEN 'type:bookingid' END,"
    " CASE WHEN l_partkey % 17 = 0 THEN 'type:speed' END) AS broken FROM fx_dup) d"
)
# Full windows are scored when their last message has come: by the first version up to the middle of all messages.
_SWAPPED = (
    "SELECT bookingid, window_idx, time, speed, CASE WHEN last_seq <= half THEN CAST(spread > 4 AS INTEGER)"
    " ELSE CAST(spread > 5 AS INTEGER) END AS label, CASE WHEN last_seq <= half THEN '1' ELSE '2' END AS model_version FROM"
    f" (SELECT bookingid, window_idx, {r('MAX(second)', 'time')}, {r('AVG(speed)', 'speed')}, STDDEV_SAMP(speed) AS spread,"
    " MAX(seq) AS last_seq FROM windowed WHERE window_idx < full_windows GROUP BY bookingid, window_idx) w,"
    " (SELECT (MIN(seq) + MAX(seq)) // 2 AS half FROM fx_stream) h"
)
_SEQUENCES = (
    "SELECT bookingid, chunk, CAST(COUNT(*) AS INTEGER) AS records, MIN(second) AS first_second,"
    f" MAX(second) AS last_second, {r('ARG_MIN(speed, second)', 'first_speed')},"
    f" {r('ARG_MAX(speed, second)', 'last_speed')} FROM (SELECT bookingid, second, speed,"
    f" (ROW_NUMBER() OVER (PARTITION BY bookingid ORDER BY second) - 1) // {CHUNK_ROWS} AS chunk"
    " FROM fx_raw) t GROUP BY bookingid, chunk"
)


def _consolidated(label: str) -> str:
    return (
        f"SELECT bookingid, {_ROUNDED}, {label} AS label FROM (SELECT bookingid, {_FILLED}, label FROM labelled"
        " WHERE bookingid NOT IN (SELECT bookingid FROM fx_done)) t"
    )


def _messages(where: str) -> str:
    return (
        f"SELECT bookingid, window_idx, is_tail, {r('second', 'time')}, {r('COALESCE(avg_speed, 0e0)', 'speed')},"
        f" CASE WHEN COALESCE(std_speed, 0e0) > {STD_SPEED_LIMIT} THEN 1 ELSE 0 END AS label"
        f" FROM ({_WINDOW_FEATURES.format(where=where)}) w"
    )


_IN_TRAIN = (
    f"('0x' || SUBSTR(MD5(CAST(bookingid AS VARCHAR) || ':{SEED}'), 1, 8))::BIGINT % 10000 < {round(TRAIN_FRACTION * 10000)}"
)
_IN_EXPERIMENT = _IN_TRAIN.replace("< 7000", "< 8000")
_DEVIATION = "CASE WHEN s.{0} = 0 THEN 0e0 ELSE t.{0} / s.{0} END"
_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, CASE WHEN STDDEV_POP({n}) * STDDEV_POP(label) = 0 THEN NULL"
    f" ELSE ABS(CORR({n}, CAST(label AS DOUBLE))) END AS score FROM trips"
    for n in _NAMES
)
_COUNTS = {
    "raw": "SUM(samples)",
    "trips": "COUNT(*)",
    "labelled": "COUNT(label)",
    "train": f"COUNT(*) FILTER (WHERE {_IN_TRAIN})",
    "test": f"COUNT(*) FILTER (WHERE NOT ({_IN_TRAIN}))",
    "consolidated": "COUNT(*) FILTER (WHERE bookingid IN (SELECT bookingid FROM fx_done))",
}
_AUC = (
    "SELECT model, ROUND(SUM(pos * (below + neg / 2.0e0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS auc FROM"
    " (SELECT *, SUM(neg) OVER (PARTITION BY model ORDER BY score) - neg AS below FROM"
    " (SELECT model, score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM fx_scores GROUP BY model, score) g) p"
    " GROUP BY model"
)
_F1 = (
    "SELECT model, ROUND(SUM(labelled * 2e0 * hits / (labelled + predicted)) / SUM(labelled), 6) AS f1 FROM"
    " (SELECT m.model, c.class, COUNT(*) FILTER (WHERE label = c.class) AS labelled,"
    " COUNT(*) FILTER (WHERE prediction = c.class) AS predicted,"
    " COUNT(*) FILTER (WHERE label = c.class AND prediction = c.class) AS hits"
    " FROM fx_scores m, (VALUES (0), (1)) c(class) GROUP BY m.model, c.class) k GROUP BY model"
)


def all_oracles() -> dict[str, str]:
    return {
        "ingest_csv": with_views(f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw", "fx_raw"),
        "ingest_batch": with_views(f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw", "fx_raw"),
        "ingest_batch_rerun": with_views(f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw", "fx_raw"),
        "decode_messages": with_views(
            "SELECT seq, CASE WHEN seq % 10 IN (3, 6, 9) THEN NULL ELSE bookingid END AS bookingid,"
            " CASE WHEN seq % 10 IN (3, 6, 9) THEN NULL ELSE seq + 0.5e0 END AS second, seq % 10 IN (3, 6, 9) AS rejected"
            " FROM fx_stream",
            "fx_stream",
        ),
        "labels_csv": with_views("SELECT bookingid, label FROM once", "once"),
        "append_raw": with_views(f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw", "fx_raw"),
        "append_trips": with_views(
            f"SELECT bookingid, {_ROUNDED}, CASE WHEN bookingid % 2 = 0 THEN label ELSE -1 END AS label FROM trips",
            "trips",
        ),
        "raw_first_writer_wins": with_views(
            _FIRST_WRITER.format(speed=r("speed"), order=", ".join(DUP_ARRIVAL)), "fx_dup"
        ),
        "insert_raw": with_views(
            _FIRST_WRITER.format(speed=r("speed"), order="l_suppkey % 2, " + ", ".join(DUP_ARRIVAL)), "fx_dup"
        ),
        "compact_raw": with_views(f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw", "fx_raw"),
        "read_stored_ids": with_views(
            f"SELECT bookingid, {r('second')}, {r('speed')} FROM fx_raw WHERE bookingid IN (SELECT bookingid FROM fx_done)",
            "fx_raw", "fx_done",
        ),
        "route_rows": with_views(_ROUTED, "fx_dup"),
        "insert_checked": with_views(_ROUTED, "fx_dup"),
        "validate_schema": with_views(
            "SELECT 'not_null:bookingid' AS rule, COUNT(*) AS violations FROM fx_dup WHERE bookingid IS NULL"
            " UNION ALL SELECT 'not_null:second', COUNT(*) FROM fx_dup WHERE second IS NULL"
            " UNION ALL SELECT 'not_null:speed', COUNT(*) FROM fx_dup WHERE NULLIF(speed, 7 * PI() / 8) IS NULL"
            " UNION ALL SELECT 'unique:bookingid,second', COUNT(*) FROM (SELECT bookingid, second FROM fx_dup"
            " GROUP BY bookingid, second HAVING COUNT(*) > 1) d",
            "fx_dup",
        ),
        "validate_trips": with_views(
            "SELECT 'type:' || c AS rule, CAST(CASE WHEN c = 'label' THEN 1 ELSE 0 END AS BIGINT) AS violations FROM"
            f" (SELECT UNNEST([{', '.join(repr(n) for n in ('bookingid', *_NAMES, 'label'))}]) AS c) u UNION ALL "
            + " UNION ALL ".join(
                f"SELECT 'not_null:{n}', COUNT(*) FILTER (WHERE {n} IS NULL) FROM short" for n in ("bookingid", *_NAMES[:-1])
            )
            + " UNION ALL SELECT 'unique:bookingid', COUNT(*) - COUNT(DISTINCT bookingid) FROM short",
            "fx_gaps",
            extra={"short": _features_of("fx_gaps")},
        ),
        "trips_all": with_views(_TRIPS_OUT, "trips"),
        "trip_lookup": with_views(f"{_TRIPS_OUT} WHERE bookingid = {LOOKUP_ID}", "trips"),
        "sample_magnitudes": with_views(
            f"SELECT bookingid, second, {r('accel_mag')}, {r('gyro_mag')} FROM"
            f" (SELECT bookingid, second, {_MAGNITUDES} FROM fx_raw) m",
            "fx_raw",
        ),
        "normalise_columns": with_views("SELECT bookingid, label FROM fx_labels", "fx_labels"),
        "fill_missing": with_views(
            f"SELECT f.bookingid, {', '.join(r(f'COALESCE(f.{n}, 0e0)', n) for n in _NAMES)},"
            " COALESCE(o.label, 0) AS label FROM short f LEFT JOIN once o ON f.bookingid = o.bookingid",
            "once",
            "fx_gaps",
            extra={"short": _features_of("fx_gaps")},
        ),
        "drop_identifier": with_views(f"SELECT {_ROUNDED}, label FROM trips", "trips"),
        "label_as_int": with_views("SELECT bookingid, label FROM fx_labels", "fx_labels"),
        "trip_summary_card": with_views(
            "SELECT bookingid, " + ", ".join(r(name, digits=2) for name in CARD_COLUMNS) + " FROM trips", "trips"
        ),
        "trip_status": with_views(
            f"SELECT bookingid, label, CASE WHEN label = 0 THEN '{SAFE_MESSAGE}' WHEN label IS NOT NULL"
            f" THEN '{DANGER_MESSAGE}' END AS status FROM labelled",
            "labelled",
        ),
        "pending_samples": with_views(
            f"SELECT bookingid, second, {r('speed')} FROM fx_raw"
            " WHERE bookingid NOT IN (SELECT bookingid FROM fx_done)",
            "fx_raw",
            "fx_done",
        ),
        "trips_with_label": with_views(
            f"SELECT bookingid, {r('avg_speed')}, second, label FROM labelled", "labelled"
        ),
        "unique_labels": with_views(
            "SELECT bookingid, label FROM (SELECT *, COUNT(*) OVER (PARTITION BY bookingid) AS c FROM fx_labels) t"
            " WHERE c = 1",
            "fx_labels",
        ),
        "trip_features": with_views(f"SELECT bookingid, {_ROUNDED} FROM features", "features"),
        "label_multiplicity": with_views(
            "SELECT bookingid, COUNT(*) AS copies FROM fx_labels GROUP BY bookingid", "fx_labels"
        ),
        "label_classes": with_views("SELECT COUNT(*) AS classes FROM (SELECT DISTINCT label FROM fx_labels) d", "fx_labels"),
        "trip_safety_counts": with_views(_PANEL.format(_safety("labelled")), "labelled"),
        "trip_speed_histogram": with_views(_PANEL.format(_SPEED), "trips"),
        "trip_speed_std_histogram": with_views(_PANEL.format(_SPEED_STD), "trips"),
        "trip_duration_buckets": with_views(_PANEL.format(_DURATION), "trips"),
        "trip_dashboard": with_views(
            " UNION ALL ".join(
                f"SELECT panel, position, bucket, trips FROM ({text}) p"
                for text in (_safety("trips"), _SPEED, _SPEED_STD, _DURATION)
            ),
            "trips",
        ),
        "trip_sequences": with_views(_SEQUENCES, "fx_raw"),
        "trip_sequences_long_trips": with_views(_SEQUENCES, "fx_raw"),
        "count_windows": with_views(_WINDOW_SUMMARY.format(where=""), "windowed"),
        "count_windows_long_trips": with_views(_WINDOW_SUMMARY.format(where=""), "windowed"),
        "window_features": with_views(
            f"SELECT bookingid, window_idx, rows, is_tail,"
            f" {', '.join(r(f'COALESCE({n}, 0e0)', n) for n in _NAMES)}"
            f" FROM ({_WINDOW_FEATURES.format(where='')}) w",
            "windowed",
        ),
        "latest_trip_state": with_views(_LATEST, "fx_stream"),
        "ordered_samples": with_views(f"SELECT bookingid, second, {r('speed')} FROM fx_raw", "fx_raw"),
        "first_trips": with_views(
            f"SELECT bookingid, {_RAW_ROUNDED} FROM fx_raw WHERE bookingid IN"
            " (SELECT DISTINCT bookingid FROM fx_raw ORDER BY bookingid LIMIT 3)",
            "fx_raw",
        ),
        "consolidate_trips": with_views(_consolidated("COALESCE(label, 0)"), "labelled", "fx_done"),
        "consolidate_trips_open_labels": with_views(_consolidated("label"), "labelled", "fx_done"),
        "prediction_message": with_views(_messages(""), "windowed"),
        "stream_ingest": with_views(_FIRST_WRITER.format(speed=r("speed"), order=", ".join(DUP_ARRIVAL)), "fx_dup"),
        "stream_count_windows": with_views(_WINDOW_SUMMARY.format(where=""), "windowed"),
        "stream_latest_state": with_views(_LATEST, "fx_stream"),
        "stream_idle_flush": with_views(_WINDOW_SUMMARY.format(where=""), "windowed"),
        "stream_predictions_once": with_views(
            f"SELECT bookingid, window_idx, time, speed, label FROM ({_messages('')}) m", "windowed"
        ),
        "stream_model_swap": with_views(_SWAPPED, "windowed"),
        "stream_predict_rule": with_views(_messages(""), "windowed"),
        "assemble_features": with_views(
            "SELECT bookingid, " + ", ".join(r(n) for n in MODEL_FEATURES) + " FROM trips", "trips"
        ),
        "scale_features": with_views(
            "SELECT t.bookingid, " + ", ".join(r(_DEVIATION.format(n), n) for n in MODEL_FEATURES)
            + " FROM trips t CROSS JOIN (SELECT " + ", ".join(f"STDDEV_SAMP({n}) AS {n}" for n in MODEL_FEATURES)
            + " FROM trips) s",
            "trips",
        ),
        "train_test_split": with_views(
            f"SELECT bookingid, label, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS part FROM trips", "trips"
        ),
        "dataset_counts": with_views(
            " UNION ALL ".join(f"SELECT '{n}' AS dataset, CAST({e} AS BIGINT) AS rows FROM sized" for n, e in _COUNTS.items()),
            "fx_raw",
            "once",
            "fx_done",
            extra={
                "sized": "SELECT s.bookingid, s.samples, o.label FROM (SELECT bookingid, COUNT(*) AS samples FROM fx_raw"
                         " GROUP BY bookingid) s LEFT JOIN once o ON s.bookingid = o.bookingid"
            },
        ),
        "pearson_selection": with_views(
            f"SELECT feature, {r('score')} FROM ({_CORRELATIONS}) c WHERE score > 0.01", "trips"
        ),
        "rank_features": with_views(
            "SELECT feature, score, CAST(ROW_NUMBER() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank"
            f" FROM (SELECT feature, {r('score')} FROM ({_CORRELATIONS}) c WHERE score IS NOT NULL) k",
            "trips",
        ),
        "train_job": with_views(
            "SELECT v.name, v.version, v.alias, CAST(20 AS BIGINT) AS num_trees, CAST(10 AS BIGINT) AS max_depth,"
            f" COUNT(*) FILTER (WHERE {_IN_TRAIN}) AS training_data_count,"
            f" COUNT(*) FILTER (WHERE NOT ({_IN_TRAIN})) AS testing_data_count, TRUE AS valid_auc"
            " FROM trips, (VALUES ('trips', '1', 'champion'), ('trips', '2', NULL)) v(name, version, alias)"
            " GROUP BY v.name, v.version, v.alias",
            "trips",
        ),
        **{
            name: with_views(f"SELECT bookingid, label, TRUE AS valid FROM trips WHERE NOT ({_IN_EXPERIMENT})", "trips")
            for name in ("train_random_forest", "train_logistic", "train_svm", "train_mlp")
        },
        "train_on_rule": with_views(
            "SELECT model, COUNT(*) AS rows, CAST(SUM(CASE WHEN std_speed > 8 THEN 1 ELSE 0 END) AS BIGINT) AS positives, TRUE AS learnt"
            f" FROM (VALUES ('forest'), ('logistic'), ('svm'), ('mlp')) m(model), trips WHERE NOT ({_IN_EXPERIMENT}) GROUP BY model",
            "trips",
        ),
        "score_trips": with_views("SELECT bookingid, label, TRUE AS valid FROM trips", "trips"),
        "stream_predict": with_views(
            f"SELECT bookingid, window_idx, is_tail, time, speed, TRUE AS valid FROM ({_messages('')}) m", "windowed"
        ),
        "compare_models": with_views(
            "SELECT model, COUNT(*) AS rows, COUNT(*) FILTER (WHERE label = 1) AS positives,"
            " COUNT(*) FILTER (WHERE label <> 1) AS negatives, model <> 'SVM' AS has_auc, TRUE AS valid FROM (VALUES ('Random Forest'),"
            f" ('Logistic Regression'), ('SVM'), ('Neural Network')) m(model), trips WHERE NOT ({_IN_EXPERIMENT}) GROUP BY model",
            "trips",
        ),
        "predict_gap_rule": with_views(
            "SELECT model, bookingid, CAST(std_speed > 8 AS INTEGER) AS prediction FROM (VALUES ('forest'), ('logistic'),"
            f" ('svm'), ('mlp')) m(model), trips WHERE NOT ({_IN_EXPERIMENT})"
            f" UNION ALL SELECT 'served', bookingid, CAST(std_speed > 8 AS INTEGER) FROM trips WHERE NOT ({_IN_TRAIN})",
            "trips",
        ),
        "split_gains": with_views(_SPLIT_GAINS, "trips"),
        "balanced_scan": with_views(_BALANCED_SCAN, "fx_raw"),
        **{
            name: f"SELECT feature, TRUE AS {flag} FROM (SELECT UNNEST([{', '.join(repr(n) for n in _NAMES)}]) AS feature) f"
            for name, flag in (("feature_importance", "valid"), ("forest_audit", "agrees"), ("lasso_selection", "optimal"), ("feature_consensus", "as_voted"))
        },
        "feature_consensus_fixed": with_views(
            "SELECT feature, score > 0.01 AS forest, score > 0.02 AS lasso, score > 0.03 AS pearson,"
            " CAST((score > 0.01) AS INTEGER) + CAST((score > 0.02) AS INTEGER) + CAST((score > 0.03) AS INTEGER) AS votes,"
            f" score > 0.02 OR feature = 'second' AS keep FROM ({_CORRELATIONS}) c WHERE score > 0.01",
            "trips",
        ),
        "eval_auc": with_views(_AUC, "fx_scores"),
        "eval_auc_fine_scores": with_views(_AUC.replace("score", "fine_score").replace("fx_fine_scores", "fx_scores"), "fx_scores"),
        "eval_accuracy": with_views(
            "SELECT model, ROUND(AVG(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6) AS accuracy"
            " FROM fx_scores GROUP BY model",
            "fx_scores",
        ),
        "eval_f1": with_views(_F1, "fx_scores"),
        "resolve_model_version": with_views(
            "SELECT name, version, run_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY"
            " CASE WHEN alias = 'champion' THEN 0 ELSE 1 END, CAST(version AS BIGINT) DESC) AS rn FROM fx_registry) t"
            " WHERE rn = 1",
            "fx_registry",
        ),
    }
