"""Independent DuckDB SQL for each registered query.

Written directly from the rules (views, windows, folds), not generated from
the Spark plans. The occupancy fold is a recursive, row-by-row fold here, so
it checks the chunked closed form used on Spark. Epoch milliseconds use
``epoch_us(x) // 1000`` (floor, as Spark and Java do; ``epoch_ms`` rounds).
"""

from __future__ import annotations

# Fixture views over the driver ``events`` table, shared by every query.
_VIEWS = """
loc_base AS (
  SELECT 'KBZ ' || CAST(user_id AS VARCHAR) AS matatuId,
         CASE WHEN event_id % 7 = 0 THEN 'route_99'
              ELSE (['route_33','route_23','route_58','route_111','route_46'])[CAST(user_id % 5 AS INTEGER) + 1]
         END AS routeId,
         CAST(-1.2921 AS DOUBLE) + value / CAST(10000.0 AS DOUBLE) AS latitude,
         CAST(36.8219 AS DOUBLE) + value / CAST(10000.0 AS DOUBLE) AS longitude,
         value AS speedKmh,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 34 AS passengersOnboard,
         ts AS "timestamp",
         event_id AS eventId
  FROM events WHERE event_type IN ('click', 'view', 'error')
),
locations AS (
  SELECT matatuId, routeId, 'Route ' || regexp_replace(routeId, '^route_', '') AS routeName,
         latitude, longitude, speedKmh, passengersOnboard, "timestamp", eventId
  FROM loc_base
),
fares AS (
  SELECT 'TXN-' || CAST(event_id AS VARCHAR) AS transactionId,
         'KBZ ' || CAST(user_id AS VARCHAR) AS matatuId,
         'PAX-' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS passengerId,
         CAST(CAST(value AS DECIMAL(12, 2)) AS DECIMAL(18, 2)) AS amountKes,
         (['MPESA', 'CASH', 'CARD'])[CAST(event_id % 3 AS INTEGER) + 1] AS paymentMethod,
         CASE WHEN event_id % 10 = 0 THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'PENDING'
              ELSE 'SUCCESS' END AS status,
         ts AS "timestamp",
         event_id AS eventId,
         CASE WHEN event_id % 13 = 0 THEN ts + INTERVAL 2 HOUR ELSE ts END AS arrivalTs
  FROM events WHERE event_type IN ('purchase', 'signup')
),
sacco_dim(routeId, saccoId, saccoName, terminus) AS (
  VALUES ('route_33', 'sacco_01', 'Citi Hoppa', 'Kikuyu Town'),
         ('route_23', 'sacco_02', 'KBS', 'Westlands'),
         ('route_58', 'sacco_03', 'Double M', 'Kawangware'),
         ('route_111', 'sacco_04', 'Metro Trans', 'Rongai'),
         ('route_46', 'sacco_05', 'Forward Travellers', 'Eastleigh')
),
revenue_keys(idx, saccoId, saccoName) AS (
  VALUES (0, 'route_111', 'Metro Trans'), (1, 'route_23', 'KBS'), (2, 'route_33', 'Citi Hoppa'),
         (3, 'route_46', 'Forward Travellers'), (4, 'route_58', 'Double M')
),
sacco_keys(idx, saccoId, saccoName) AS (
  VALUES (0, 'sacco_01', 'Citi Hoppa'), (1, 'sacco_02', 'KBS'), (2, 'sacco_03', 'Double M'),
         (3, 'sacco_04', 'Metro Trans'), (4, 'sacco_05', 'Forward Travellers')
),
succ AS (
  SELECT f.*, k.saccoId, k.saccoName
  FROM fares f JOIN revenue_keys k
    ON k.idx = list_reduce(list_transform(string_split(f.matatuId, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                           lambda h, x: (h * 31 + x) & 2147483647, CAST(0 AS BIGINT)) % 5
  WHERE f.status = 'SUCCESS'
),
fare_audit AS (
  SELECT *,
         (epoch_us("timestamp") // 3600000000) * 3600000000 AS start_us,
         max(epoch_us("timestamp")) OVER (PARTITION BY saccoId ORDER BY arrivalTs, eventId
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_us
  FROM succ
),
deltas AS (
  SELECT matatuId, routeId, routeName,
         CAST(passengersOnboard - coalesce(lag(passengersOnboard) OVER (PARTITION BY matatuId ORDER BY "timestamp", eventId), 0) AS INTEGER) AS passengerDelta,
         passengersOnboard, "timestamp", eventId
  FROM locations
),
gaps AS (
  SELECT l.*,
         lead("timestamp") OVER (PARTITION BY matatuId ORDER BY "timestamp", eventId) AS nextSeenAt,
         epoch_us("timestamp") // 1000 AS last_ms,
         (epoch_us("timestamp") // 1000 + 300001 + 59999) // 60000 AS k1
  FROM locations l
),
gap_ticks AS (
  SELECT *,
         CASE WHEN nextSeenAt IS NOT NULL THEN (epoch_us(nextSeenAt) - 1) // 60000000
              ELSE epoch_us((SELECT max("timestamp") FROM locations)) // 60000000 END AS k2
  FROM gaps
)
"""


def _q(body: str) -> str:
    return "WITH RECURSIVE " + _VIEWS.strip() + "\n" + body.strip()


_LOC_COLS = 'matatuId, routeId, routeName, latitude, longitude, speedKmh, passengersOnboard, "timestamp", eventId'
_FARE_COLS = "transactionId, matatuId, passengerId, amountKes, paymentMethod, status, \"timestamp\", eventId"

_OCCUPANCY_FOLD = """
, numbered AS (
  SELECT *, greatest(0, passengerDelta) AS boardings, greatest(0, -passengerDelta) AS alightings,
         row_number() OVER (PARTITION BY routeId ORDER BY "timestamp", eventId) AS rn
  FROM deltas
),
fold AS (
  SELECT routeId, rn, routeName, greatest(0, passengerDelta) AS currentPassengers,
         CAST(boardings AS BIGINT) AS totalBoardings, CAST(alightings AS BIGINT) AS totalAlightings,
         matatuId, passengerDelta, "timestamp", eventId
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.routeId, n.rn, n.routeName, greatest(0, f.currentPassengers + n.passengerDelta),
         f.totalBoardings + n.boardings, f.totalAlightings + n.alightings,
         n.matatuId, n.passengerDelta, n."timestamp", n.eventId
  FROM fold f JOIN numbered n ON n.routeId = f.routeId AND n.rn = f.rn + 1
)
"""

# Alert rows of hourly checks: the first tick over five minutes of silence, and
# on to the next ping (or the last ping of all).
_HOURLY_ALERTS = """
SELECT matatuId, routeId, routeName, latitude AS lastKnownLatitude,
       longitude AS lastKnownLongitude, k * 3600000 - last_ms AS silenceDurationMs,
       "timestamp" AS lastSeenAt, make_timestamp(k * 3600000000) AS alertRaisedAt
FROM (SELECT *, unnest(generate_series(h1, h2)) AS k
      FROM (SELECT *, (last_ms + 300001 + 3599999) // 3600000 AS h1,
                   CASE WHEN nextSeenAt IS NOT NULL THEN (epoch_us(nextSeenAt) - 1) // 3600000000
                        ELSE epoch_us((SELECT max("timestamp") FROM locations)) // 3600000000 END AS h2
            FROM gaps)
      WHERE h2 >= h1)"""

ORACLE_SQL: dict[str, str] = {
    "location_source": _q(f"SELECT {_LOC_COLS} FROM locations"),
    "fare_source": _q(f"SELECT {_FARE_COLS}, arrivalTs FROM fares"),
    "speed_alerts": _q(f"SELECT {_LOC_COLS} FROM locations WHERE speedKmh > 80.0"),
    "speed_alert_messages": _q(
        """SELECT matatuId, eventId,
                  format('[SPEED ALERT]  Matatu {} on {} doing {} km/h (threshold: 80.0 km/h)',
                         matatuId, routeName, CAST(speedKmh AS VARCHAR)) AS message
           FROM locations WHERE speedKmh > 80.0"""
    ),
    "enriched_locations": _q(
        """SELECT l.matatuId, l.routeId, l.routeName,
                  coalesce(d.saccoName, 'Unknown Sacco') AS saccoName,
                  coalesce(d.saccoId, 'unknown') AS saccoId,
                  coalesce(d.terminus, 'Unknown Terminus') AS terminus,
                  l.latitude, l.longitude, l.speedKmh, l.passengersOnboard,
                  l.speedKmh > 80.0 AS isSpeeding, l."timestamp" AS originalTimestamp, l.eventId
           FROM locations l LEFT JOIN sacco_dim d ON l.routeId = d.routeId"""
    ),
    "enrichment_messages": _q(
        """SELECT l.matatuId, l.eventId,
                  CASE WHEN d.saccoId IS NULL
                       THEN format('[ENRICHMENT] ⚠️ No SACCO found for routeId=''{}'' on matatu ''{}''', l.routeId, l.matatuId)
                       ELSE format('[ENRICHMENT] ✅ {} on {} ({}) enriched with SACCO: {}', l.matatuId, l.routeName, l.routeId, d.saccoName)
                  END AS message
           FROM locations l LEFT JOIN sacco_dim d ON l.routeId = d.routeId"""
    ),
    "unknown_routes": _q(
        """SELECT routeId, count(*) AS pings, count(DISTINCT matatuId) AS vehicles,
                  min("timestamp") AS firstSeen, max("timestamp") AS lastSeen
           FROM locations WHERE routeId NOT IN (SELECT routeId FROM sacco_dim)
           GROUP BY routeId"""
    ),
    "fare_branches": _q(
        f"""SELECT {_FARE_COLS},
                   CASE WHEN status = 'FAILED' THEN 'failed' WHEN status = 'SUCCESS' THEN 'success'
                        ELSE 'default' END AS branch
            FROM fares"""
    ),
    "failed_fares": _q(f"SELECT {_FARE_COLS} FROM fares WHERE status = 'FAILED'"),
    "fare_branch_messages": _q(
        """SELECT transactionId,
                  CASE WHEN status = 'FAILED' THEN 'failed' WHEN status = 'SUCCESS' THEN 'success'
                       ELSE 'default' END AS branch,
                  CASE WHEN status = 'FAILED'
                       THEN format('[FARES] ❌ Failed payment → txn={}, matatu={}, amount=KES {}, method={}',
                                   transactionId, matatuId, CAST(amountKes AS VARCHAR), paymentMethod)
                       WHEN status = 'SUCCESS'
                       THEN format('[FARES] ✅ Success → txn={}, matatu={}, amount=KES {}, method={}',
                                   transactionId, matatuId, CAST(amountKes AS VARCHAR), paymentMethod)
                       ELSE format('[FARES] ⏳ Pending → txn={}, matatu={}', transactionId, matatuId)
                  END AS message
           FROM fares"""
    ),
    "fare_branch_summary": _q(
        """SELECT CASE WHEN status = 'FAILED' THEN 'failed' WHEN status = 'SUCCESS' THEN 'success'
                       ELSE 'default' END AS branch,
                  count(*) AS fares, CAST(sum(amountKes) AS DECIMAL(18, 2)) AS amountKes
           FROM fares GROUP BY 1"""
    ),
    "location_decode": _q(f"SELECT {_LOC_COLS} FROM locations"),
    "location_ingest": _q(
        """SELECT matatuId, routeId, routeName, latitude, longitude, speedKmh,
                  CASE WHEN eventId % 50 = 5 THEN 0 ELSE passengersOnboard END AS passengersOnboard,
                  "timestamp", eventId
           FROM locations WHERE eventId % 50 NOT IN (1, 2, 3, 4)"""
    ),
    "location_quarantine": _q(
        """SELECT eventId,
                  CASE eventId % 50 WHEN 1 THEN '  ' WHEN 4 THEN NULL ELSE matatuId END AS matatuId,
                  CASE eventId % 50 WHEN 2 THEN '' WHEN 4 THEN NULL ELSE routeId END AS routeId,
                  CASE eventId % 50 WHEN 1 THEN 'matatuId must not be blank'
                       WHEN 2 THEN 'routeId must not be blank'
                       WHEN 3 THEN 'speedKmh must not be negative'
                       ELSE 'malformed record' END AS invalidReason
           FROM locations WHERE eventId % 50 IN (1, 2, 3, 4)"""
    ),
    "fare_quarantine": _q(
        """SELECT eventId, CASE WHEN eventId % 50 <> 4 THEN transactionId END AS transactionId,
                  CASE eventId % 50 WHEN 2 THEN 'status must be one of SUCCESS, FAILED, PENDING'
                       WHEN 4 THEN 'malformed record'
                       ELSE 'paymentMethod must be one of MPESA, CASH, CARD' END AS invalidReason
           FROM fares WHERE eventId % 50 IN (1, 2, 3, 4)"""
    ),
    "fare_decode": _q(f"SELECT {_FARE_COLS} FROM fares"),
    "display_board": _q(
        """, placed AS (SELECT event_id, row_number() OVER () - 1 AS "offset" FROM events)
           SELECT matatuId, routeId, routeName, latitude, longitude, speedKmh, passengersOnboard,
                  'events.parquet' AS "partition", routeId AS "key", p."offset", "timestamp" AS recordTimestamp
           FROM locations l JOIN placed p ON p.event_id = l.eventId"""
    ),
    "fare_log": _q(
        """SELECT CASE status WHEN 'SUCCESS' THEN '✅' WHEN 'FAILED' THEN '❌' WHEN 'PENDING' THEN '⏳' END AS icon,
                  transactionId, matatuId, amountKes, paymentMethod, status, eventId,
                  format('[FARES] {} Payment → txn={}, matatu={}, amount=KES {}, method={}, status={}',
                         CASE status WHEN 'SUCCESS' THEN '✅' WHEN 'FAILED' THEN '❌' WHEN 'PENDING' THEN '⏳' END,
                         transactionId, matatuId, CAST(amountKes AS VARCHAR), paymentMethod, status) AS message
           FROM fares"""
    ),
    "location_audit": _q(
        """SELECT matatuId, routeId, latitude, longitude, speedKmh, eventId,
                  CAST("timestamp" AS DATE) AS eventDate
           FROM locations"""
    ),
    "operator_assignment": _q(
        """SELECT DISTINCT f.matatuId, k.saccoId
           FROM fares f JOIN revenue_keys k
             ON k.idx = list_reduce(list_transform(string_split(f.matatuId, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                                    lambda h, x: (h * 31 + x) & 2147483647, CAST(0 AS BIGINT)) % 5"""
    ),
    "sacco_revenue": _q(
        """SELECT saccoId, saccoName, CAST(sum(amountKes) AS DECIMAL(18, 2)) AS totalRevenueKes,
                  count(*) AS transactionCount,
                  make_timestamp(start_us) AS windowStart, make_timestamp(start_us + 3600000000) AS windowEnd
           FROM (SELECT *, (epoch_us("timestamp") // 3600000000) * 3600000000 AS start_us FROM succ)
           GROUP BY saccoId, saccoName, start_us"""
    ),
    "sacco_revenue_by_sacco_id": _q(
        """SELECT k.saccoId, k.saccoName, CAST(sum(f.amountKes) AS DECIMAL(18, 2)) AS totalRevenueKes,
                  count(*) AS transactionCount,
                  make_timestamp((epoch_us(f."timestamp") // 3600000000) * 3600000000) AS windowStart,
                  make_timestamp((epoch_us(f."timestamp") // 3600000000) * 3600000000 + 3600000000) AS windowEnd
           FROM fares f JOIN sacco_keys k
             ON k.idx = list_reduce(list_transform(string_split(f.matatuId, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                                    lambda h, x: (h * 31 + x) & 2147483647, CAST(0 AS BIGINT)) % 5
           WHERE f.status = 'SUCCESS'
           GROUP BY k.saccoId, k.saccoName, (epoch_us(f."timestamp") // 3600000000)"""
    ),
    "sacco_revenue_messages": _q(
        """SELECT saccoId, make_timestamp(start_us) AS windowStart,
                  format('[REVENUE] 💰 SACCO: {} | Window: {} → {} | Total: KES {} | Transactions: {}',
                         saccoName,
                         strftime(make_timestamp(start_us), '%Y-%m-%dT%H:%M:%SZ'),
                         strftime(make_timestamp(start_us + 3600000000), '%Y-%m-%dT%H:%M:%SZ'),
                         CAST(CAST(sum(amountKes) AS DECIMAL(18, 2)) AS VARCHAR),
                         CAST(count(*) AS VARCHAR)) AS message
           FROM (SELECT *, (epoch_us("timestamp") // 3600000000) * 3600000000 AS start_us FROM succ)
           GROUP BY saccoId, saccoName, start_us"""
    ),
    "late_fares": _q(
        """SELECT transactionId, matatuId, saccoId, amountKes, "timestamp", arrivalTs, eventId,
                  make_timestamp(start_us) AS windowStart, make_timestamp(start_us + 3600000000) AS windowEnd,
                  make_timestamp(stream_us) AS streamTime
           FROM fare_audit WHERE start_us + 3600000000 + 300000000 <= stream_us"""
    ),
    "sacco_revenue_emitted": _q(
        """SELECT a.saccoId, a.saccoName, CAST(sum(a.amountKes) AS DECIMAL(18, 2)) AS totalRevenueKes,
                  count(*) AS transactionCount,
                  make_timestamp(a.start_us) AS windowStart, make_timestamp(a.start_us + 3600000000) AS windowEnd
           FROM fare_audit a
           JOIN (SELECT saccoId, max(epoch_us("timestamp")) AS final_us FROM succ GROUP BY saccoId) f
             ON a.saccoId = f.saccoId
           WHERE a.start_us + 3600000000 + 300000000 > a.stream_us
             AND a.start_us + 3600000000 + 300000000 <= f.final_us
           GROUP BY a.saccoId, a.saccoName, a.start_us"""
    ),
    "passenger_deltas": _q(
        """SELECT matatuId, routeId, routeName, passengerDelta,
                  greatest(0, passengerDelta) AS boardings, greatest(0, -passengerDelta) AS alightings,
                  passengersOnboard, "timestamp", eventId
           FROM deltas"""
    ),
    "vehicle_snapshots": _q(
        """SELECT matatuId, arg_max(routeId, ("timestamp", eventId)) AS routeId,
                  arg_max(passengersOnboard, ("timestamp", eventId)) AS lastPassengerCount,
                  max("timestamp") AS lastUpdated
           FROM locations GROUP BY matatuId"""
    ),
    "route_occupancy_changelog": _q(
        _OCCUPANCY_FOLD
        + """SELECT routeId, routeName, currentPassengers, totalBoardings, totalAlightings,
                    matatuId, passengerDelta, "timestamp", eventId
             FROM fold"""
    ),
    "route_occupancy_messages": _q(
        _OCCUPANCY_FOLD
        + """SELECT routeId, eventId,
                    format('[OCCUPANCY] 🚌 Route {} | On board: {} | Boarded: {} | Alighted: {}',
                           routeId, CAST(currentPassengers AS VARCHAR), CAST(totalBoardings AS VARCHAR),
                           CAST(totalAlightings AS VARCHAR)) AS message
             FROM fold"""
    ),
    "route_occupancy": _q(
        _OCCUPANCY_FOLD
        + """SELECT routeId, arg_max(routeName, rn) AS routeName,
                    arg_max(currentPassengers, rn) AS currentPassengers,
                    arg_max(totalBoardings, rn) AS totalBoardings,
                    arg_max(totalAlightings, rn) AS totalAlightings,
                    max("timestamp") AS lastUpdated
             FROM fold GROUP BY routeId"""
    ),
    "last_seen": _q(
        """SELECT matatuId, arg_max(routeId, ("timestamp", eventId)) AS routeId,
                  arg_max(routeName, ("timestamp", eventId)) AS routeName,
                  arg_max(latitude, ("timestamp", eventId)) AS lastLatitude,
                  arg_max(longitude, ("timestamp", eventId)) AS lastLongitude,
                  max("timestamp") AS lastSeenAt
           FROM locations GROUP BY matatuId"""
    ),
    "offgrid_as_of": _q(
        """, now AS (SELECT max("timestamp") AS t FROM locations),
           seen AS (
             SELECT matatuId, arg_max(routeId, ("timestamp", eventId)) AS routeId,
                    arg_max(routeName, ("timestamp", eventId)) AS routeName,
                    arg_max(latitude, ("timestamp", eventId)) AS lastKnownLatitude,
                    arg_max(longitude, ("timestamp", eventId)) AS lastKnownLongitude,
                    max("timestamp") AS lastSeenAt
             FROM locations GROUP BY matatuId)
           SELECT s.matatuId, s.routeId, s.routeName, s.lastKnownLatitude, s.lastKnownLongitude,
                  epoch_us(now.t) // 1000 - epoch_us(s.lastSeenAt) // 1000 AS silenceDurationMs,
                  s.lastSeenAt, now.t AS alertRaisedAt
           FROM seen s, now
           WHERE epoch_us(now.t) // 1000 - epoch_us(s.lastSeenAt) // 1000 > 300000"""
    ),
    "offgrid_gaps": _q(
        """SELECT matatuId, routeId, routeName, latitude AS lastKnownLatitude,
                  longitude AS lastKnownLongitude, "timestamp" AS lastSeenAt, nextSeenAt, eventId,
                  make_timestamp(k1 * 60000000) AS firstAlertAt, make_timestamp(k2 * 60000000) AS lastAlertAt,
                  k2 - k1 + 1 AS alertCount, k2 * 60000 - last_ms AS maxSilenceMs
           FROM gap_ticks WHERE k2 >= k1"""
    ),
    "offgrid_tick_alerts": _q(_HOURLY_ALERTS),
    "offgrid_messages": _q(
        f"""SELECT matatuId, alertRaisedAt,
                  format('[OFF-GRID] 📡 Matatu {{}} on {{}} has been silent for {{}} minutes. Last seen: {{}}',
                         matatuId, routeName, CAST(silenceDurationMs // 60000 AS VARCHAR),
                         CASE WHEN epoch_us(lastSeenAt) % 1000000 = 0 THEN strftime(lastSeenAt, '%Y-%m-%dT%H:%M:%SZ')
                              WHEN epoch_us(lastSeenAt) % 1000 = 0 THEN strftime(lastSeenAt, '%Y-%m-%dT%H:%M:%S.%gZ')
                              ELSE strftime(lastSeenAt, '%Y-%m-%dT%H:%M:%S.%fZ') END) AS message
           FROM ({_HOURLY_ALERTS})"""
    ),
    "delta_messages": _q(
        """SELECT matatuId, eventId,
                  format('[DELTA] 🚌 {} | prev={} cur={} delta={}', matatuId,
                         CAST(passengersOnboard - passengerDelta AS VARCHAR),
                         CAST(passengersOnboard AS VARCHAR), CAST(passengerDelta AS VARCHAR)) AS message
           FROM deltas"""
    ),
    "location_log_messages": _q(
        """SELECT matatuId, eventId,
                  format('[LOGGER] 📝 Persisting → matatu={}, route={}, lat={}, lng={}, speed={}, offset={}',
                         matatuId, routeId, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR),
                         CAST(speedKmh AS VARCHAR), CAST(eventId AS VARCHAR)) AS message
           FROM locations"""
    ),
    "speed_alert_records": _q(
        """SELECT routeId AS "key",
                  'matatuId,routeId,routeName,latitude,longitude,speedKmh,passengersOnboard,timestamp' AS fields,
                  matatuId, routeId, routeName, latitude, longitude, speedKmh, passengersOnboard, "timestamp"
           FROM locations WHERE speedKmh > 80.0"""
    ),
    "failed_fare_records": _q(
        """SELECT matatuId AS "key",
                  'transactionId,matatuId,passengerId,amountKes,paymentMethod,status,timestamp' AS fields,
                  transactionId, matatuId, passengerId, amountKes, paymentMethod, status, "timestamp"
           FROM fares WHERE status = 'FAILED'"""
    ),
}

# Published records: the key, the names of the record's fields, the fields.
_EMITTED = ORACLE_SQL["sacco_revenue_emitted"]
ORACLE_SQL.update(
    {
        "enriched_records": _q(
            """SELECT l.routeId AS "key",
                      'matatuId,routeId,routeName,saccoName,saccoId,terminus,latitude,longitude,speedKmh,passengersOnboard,isSpeeding,originalTimestamp,enrichedAt' AS fields,
                      l.matatuId, l.routeId, l.routeName, coalesce(d.saccoName, 'Unknown Sacco') AS saccoName,
                      coalesce(d.saccoId, 'unknown') AS saccoId, coalesce(d.terminus, 'Unknown Terminus') AS terminus,
                      l.latitude, l.longitude, l.speedKmh, l.passengersOnboard, l.speedKmh > 80.0 AS isSpeeding,
                      l."timestamp" AS originalTimestamp, l."timestamp" AS enrichedAt
               FROM locations l LEFT JOIN sacco_dim d ON l.routeId = d.routeId"""
        ),
        "revenue_records": f"""SELECT saccoId AS "key",
                      'saccoId,saccoName,totalRevenueKes,transactionCount,windowStart,windowEnd,computedAt' AS fields,
                      *, windowEnd AS computedAt FROM ({_EMITTED})""",
        "occupancy_records": _q(
            _OCCUPANCY_FOLD
            + """SELECT routeId AS "key",
                        'routeId,routeName,currentPassengers,totalBoardings,totalAlightings,lastUpdated' AS fields,
                        routeId, routeName, currentPassengers, totalBoardings, totalAlightings, "timestamp" AS lastUpdated
                 FROM fold"""
        ),
        "offgrid_records": _q(
            f"""SELECT matatuId AS "key",
                      'matatuId,routeId,routeName,lastKnownLatitude,lastKnownLongitude,silenceDurationMs,lastSeenAt,alertRaisedAt' AS fields, *
               FROM ({_HOURLY_ALERTS})"""
        ),
    }
)

# The replays of the streams give what the batch rules give.
_OCCUPANCY_STATE = (
    _OCCUPANCY_FOLD
    + """SELECT routeId, arg_max(routeName, rn) AS routeName, arg_max(currentPassengers, rn) AS currentPassengers,
                arg_max(totalBoardings, rn) AS totalBoardings, arg_max(totalAlightings, rn) AS totalAlightings
         FROM fold GROUP BY routeId"""
)
ORACLE_SQL.update(
    {
        "revenue_replay": ORACLE_SQL["sacco_revenue_emitted"],
        "late_fares_replay": ORACLE_SQL["late_fares"],
        "open_windows_replay": _q(
            """SELECT a.saccoId, CAST(sum(a.amountKes) AS DECIMAL(18, 2)) AS totalRevenueKes,
                      count(*) AS transactionCount, make_timestamp(a.start_us) AS windowStart,
                      make_timestamp(a.start_us + 3600000000) AS windowEnd, make_timestamp(max(f.final_us)) AS streamTime
               FROM fare_audit a
               JOIN (SELECT saccoId, max(epoch_us("timestamp")) AS final_us FROM succ GROUP BY saccoId) f
                 ON a.saccoId = f.saccoId
               WHERE a.start_us + 3600000000 + 300000000 > f.final_us
               GROUP BY a.saccoId, a.start_us"""
        ),
        "offgrid_replay": ORACLE_SQL["offgrid_tick_alerts"],
        "last_seen_state": ORACLE_SQL["last_seen"],
        "delta_replay": _q(
            """SELECT matatuId, routeId, routeName, passengerDelta, greatest(0, passengerDelta) AS boardings,
                      greatest(0, -passengerDelta) AS alightings, "timestamp", eventId
               FROM deltas"""
        ),
        "occupancy_replay": _q(
            _OCCUPANCY_FOLD
            + """SELECT routeId, routeName, currentPassengers, totalBoardings, totalAlightings, "timestamp", eventId
                 FROM fold"""
        ),
        "route_totals_state": _q(_OCCUPANCY_STATE),
        "vehicle_counts_state": _q(
            """SELECT matatuId, arg_max(routeId, ("timestamp", eventId)) AS routeId,
                      arg_max(passengersOnboard, ("timestamp", eventId)) AS lastPassengerCount
               FROM locations GROUP BY matatuId"""
        ),
        "occupancy_table": ORACLE_SQL["route_occupancy"],
        "occupancy_handover": _q(
            _OCCUPANCY_FOLD
            + """SELECT routeId, routeName, currentPassengers, totalBoardings, totalAlightings, "timestamp", eventId
                 FROM fold
                 WHERE epoch_us("timestamp") >= (SELECT (min(epoch_us("timestamp")) + max(epoch_us("timestamp"))) // 2 FROM locations)"""
        ),
        "offgrid_handover": ORACLE_SQL["offgrid_tick_alerts"],
        "occupancy_by_parts": ORACLE_SQL["route_occupancy"],
    }
)
