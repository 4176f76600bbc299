"""The catalogue's queries as plain SQL, written independently of the operators.

Every statement is put together from named common table expressions: the views its text
mentions, and the views those mention.
"""

from __future__ import annotations

import re

# Fixed values, spelled out here so that a mistake in the operators can't hide.
ACTION_CODES = {"unfav": 0, "view": 1, "click": 2, "fav": 3, "share": 4, "purchase": 5}
AGE_BINS = (
    (0, "elementary", "group_1"),
    (13, "junior_high", "group_2"),
    (16, "high_school", "group_3"),
    (19, "undergrad", "group_4"),
    (23, "early_jobber", "group_5"),
    (26, "establishment", "group_6"),
    (30, "mid_career", "group_7"),
    (45, "senior", "group_8"),
    (60, "retirement", "group_9"),
)
UPSTREAM_TAGS = (
    "search",
    "location_bubble",
    "search_recommend",
    "favorite_list",
    "carousel",
    "banner",
)



def _bins(age: str, field: int) -> str:
    rows = sorted(AGE_BINS, reverse=True)
    cases = " ".join(f"WHEN {age} >= {r[0]} THEN '{r[field]}'" for r in rows)
    return f"CASE {cases} END"


def _code(action: str) -> str:
    return f"CASE {action} " + " ".join(f"WHEN '{a}' THEN {c}" for a, c in ACTION_CODES.items()) + " END"


def _name(code: str) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {c} THEN '{a}'" for a, c in ACTION_CODES.items()) + " END"


def _latest(source: str) -> str:
    return f"""
      SELECT raw_user_id, register_date, birth_date, g AS gender FROM (
        SELECT *, lower(gender) AS g, row_number() OVER (PARTITION BY raw_user_id ORDER BY
            register_date DESC, birth_date DESC NULLS LAST, lower(gender) DESC NULLS LAST) AS rn
        FROM {source}) WHERE rn = 1"""


VIEWS: dict[str, str] = {
    "v_events": """
      SELECT event_id, user_id, CAST(props->>'$.k' AS BIGINT) AS hotel_code,
             event_type AS event_name, ts AS event_timestamp, value AS duration FROM events""",
    "v_event_map": """
      SELECT * FROM (VALUES ('view','view',1,'search'), ('click','click',2,'carousel'),
        ('signup','fav',3,'favorite_list'), ('purchase','purchase',5,'banner'),
        ('error',NULL,NULL,'N')) t(event_name, main_action, encoded_main_action, upstream_event_tag)""",
    "v_bookings": """
      SELECT o_orderkey AS booking_id, o_custkey AS raw_user_id, l_partkey AS hotel_code,
             CASE WHEN o_orderstatus = 'F' THEN 'purchase' ELSE 'check' END AS main_action,
             o_orderdate AS updated_at, l_extendedprice AS price, lineitem.*
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "v_customer_profile": """
      SELECT c_custkey AS raw_user_id, CAST(o_orderdate AS DATE) AS register_date,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'male' WHEN 'BUILDING' THEN 'FEMALE'
          WHEN 'FURNITURE' THEN 'other' WHEN 'HOUSEHOLD' THEN 'none' END AS gender,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
          THEN DATE '1950-01-01' + CAST(floor(c_acctbal * 2.4) AS INTEGER) END AS birth_date
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_hotel_profile": """
      SELECT p_partkey AS hotel_code, language,
        CASE WHEN language = 'th' THEN upper(p_name) ELSE p_name END AS hotel_name,
        p_brand AS address1, p_type AS address2,
        CASE WHEN p_size <> 17 THEN p_name END AS address3, CAST(p_size AS VARCHAR) AS zipcode,
        CASE WHEN p_size = 23 THEN NULL WHEN p_size BETWEEN 20 AND 22 THEN ''
          WHEN p_size = 24 THEN ' Old, Town ' WHEN p_size = 45 THEN 'Old Town'
          ELSE p_type END AS location_name,
        'L' || p_brand AS location_code,
        CASE WHEN p_size <= 40 THEN 'Central City' ELSE 'Port Town' END AS city_name,
        CASE WHEN p_size <= 40 THEN 'C1' ELSE 'C2' END AS city_code,
        'Freeland' AS country_name, 'FL' AS country_code,
        'img/' || CAST(p_partkey AS VARCHAR) AS image_url, p_size % 5 + 1 AS rating,
        CASE WHEN p_size <= 45 THEN 'Y' ELSE 'N' END AS display,
        p_size AS latitude, p_retailprice AS longitude
      FROM part JOIN (VALUES ('en'), ('th')) l(language) ON language = 'en' OR p_size > 8""",
    "v_styles": """
      SELECT p_partkey AS hotel_code, p_brand AS style_name FROM part WHERE p_brand <> 'Brand#7'
      UNION ALL SELECT p_partkey, 'Grand ' || p_brand FROM part WHERE p_size > 25""",
    "v_items0": """
      SELECT p.hotel_code, latitude, longitude,
        coalesce(CASE WHEN key = 'location_oldtown_porttown' THEN 'location_historic_porttown'
                 ELSE key END, 'unspecified') AS location_name,
        coalesce(style_name, 'unspecified') AS style_name
      FROM (SELECT *, 'location_' || replace(lower(CASE WHEN location_name IS NULL OR location_name = ''
              THEN replace(trim(city_name), ' ', '')
              ELSE replace(trim(location_name), ' ', '') || '_' || replace(trim(city_name), ' ', '')
              END), ',', '') AS key FROM v_hotel_profile WHERE language = 'en') p
      LEFT JOIN (SELECT hotel_code, min(lower(replace(style_name, ' ', '_'))) AS style_name
                 FROM v_styles GROUP BY 1) s ON p.hotel_code = s.hotel_code""",
    "items": """
      SELECT *, 'hotel_' || CAST(int_hotel_id AS VARCHAR) AS hotel_id FROM (
        SELECT *, row_number() OVER (ORDER BY hotel_code) AS int_hotel_id FROM v_items0)""",
    "style_vocab": """
      SELECT style_name, row_number() OVER (ORDER BY style_name) - 1 AS index FROM (
        SELECT style_name FROM items UNION SELECT 'unspecified')""",
    "location_vocab": """
      SELECT location_name, row_number() OVER (ORDER BY location_name) - 1 AS index FROM (
        SELECT location_name FROM items UNION SELECT 'unspecified')""",
    "first_profiles": "SELECT * FROM v_customer_profile WHERE register_date < DATE '1996-01-01'",
    "existing_users": f"""
      SELECT raw_user_id, int_user_id, 'user_' || CAST(int_user_id AS VARCHAR) AS user_id, gender, age,
        register_date, DATE '2024-01-01' AS busi_dt, {_bins('age', 1)} AS age_group_label,
        {_bins('age', 2)} AS age_group
      FROM (SELECT *, row_number() OVER (ORDER BY register_date, raw_user_id) AS int_user_id,
              CAST(date_sub('year', birth_date, DATE '2024-01-01') AS DOUBLE) AS age
            FROM ({_latest('first_profiles')}))""",
    "latest_profiles": _latest("v_customer_profile"),
    "fresh_users": """
      SELECT * FROM latest_profiles
      WHERE raw_user_id NOT IN (SELECT raw_user_id FROM existing_users)""",
    "medians": """
      SELECT gender, median(age) AS median_age FROM existing_users
      WHERE age IS NOT NULL GROUP BY gender""",
    "users": f"""
      SELECT raw_user_id, int_user_id, user_id, gender, age, register_date, busi_dt,
        age_group_label, age_group FROM existing_users
      UNION ALL
      SELECT raw_user_id, int_user_id, 'user_' || CAST(int_user_id AS VARCHAR), gender, age,
        register_date, DATE '2024-01-31', {_bins('age', 1)}, {_bins('age', 2)}
      FROM (SELECT f.*, row_number() OVER (ORDER BY register_date, raw_user_id)
                + (SELECT max(int_user_id) FROM existing_users) AS int_user_id,
              coalesce(CAST(date_sub('year', birth_date, DATE '2024-01-31') AS DOUBLE), median_age) AS age
            FROM fresh_users f LEFT JOIN medians m ON f.gender = m.gender)""",
    "chain_events": """
      SELECT CAST(user_id AS BIGINT) AS user_id, CAST(hotel_id AS BIGINT) AS hotel_code, event_name, event_timestamp
      FROM unified""",
    "chain_runs": """
      SELECT CAST(user_id AS BIGINT) AS user_id, CAST(hotel_id AS BIGINT) AS hotel_code, event_name,
        max_ts AS event_timestamp FROM runs""",
    "spent": """
      SELECT uid, CAST(r.user_id AS BIGINT) AS raw_user_id, main_action,
        CAST(coalesce(hotel_id, booking_hotel_id) AS BIGINT) AS hotel_code,
        CAST(CASE WHEN booking_hotel_id IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS complete_flag,
        round(CAST(sum(total_duration) AS DOUBLE) / 60, 2) AS duration, max(max_ts) AS event_timestamp
      FROM runs r LEFT JOIN booked_items USING (booking_id) JOIN v_event_map USING (event_name)
      WHERE main_action IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "training": f"""
      SELECT u.user_id, i.hotel_id, i.style_name, f.main_action, f.event_timestamp, f.complete_flag, f.duration,
        {_code('f.main_action')} AS action_code
      FROM spent f JOIN users u ON f.raw_user_id = u.raw_user_id JOIN items i ON f.hotel_code = i.hotel_code""",
    "app_latest": """
      SELECT user_id AS raw_user_id, hotel_code, main_action, max(event_timestamp) AS event_timestamp
      FROM chain_events JOIN v_event_map USING (event_name)
      WHERE main_action IS NOT NULL AND hotel_code IS NOT NULL GROUP BY 1, 2, 3""",
    "all_events": """
      SELECT raw_user_id, hotel_code, main_action, updated_at + INTERVAL 7 HOUR AS event_timestamp
      FROM v_bookings UNION SELECT * FROM app_latest""",
    "coded_events": f"""
      SELECT raw_user_id, hotel_id, {_code('main_action')} AS main_action, event_timestamp
      FROM all_events JOIN items USING (hotel_code)
      WHERE hotel_id IN (SELECT hotel_id FROM training) AND {_code('main_action')} IS NOT NULL""",
    "behaviour": """
      SELECT user_id, list(hotel_id ORDER BY event_timestamp, hotel_id, main_action) AS hotels,
        list(main_action ORDER BY event_timestamp, hotel_id, main_action) AS acts,
        any_value(age_group) AS age_group, any_value(gender) AS gender
      FROM (SELECT *, row_number() OVER (PARTITION BY raw_user_id ORDER BY event_timestamp DESC,
              hotel_id DESC, main_action DESC) AS rn FROM coded_events)
      JOIN users USING (raw_user_id) WHERE rn <= 6 GROUP BY user_id""",
    "flagged": """
      SELECT *, CASE WHEN user_id IN (SELECT user_id FROM training) AND len(hotels) >= 6
        THEN 1 ELSE 0 END AS is_eligible FROM behaviour""",
    "item_scores": f"""
      SELECT hotel_id, code AS pred_action, share AS prob, code * share AS important_value FROM (
        SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY n DESC, code) AS rn,
          n / sum(n) OVER (PARTITION BY hotel_id) AS share
        FROM (SELECT hotel_id, {_code('main_action')} AS code, count(*) AS n FROM training GROUP BY 1, 2))
      WHERE rn = 1""",
    "trained_items": """
      SELECT i.* FROM items i WHERE hotel_id IN (SELECT hotel_id FROM training)""",
    "candidate_rows": """
      SELECT b.user_id, b.hotels[1:5] AS hotels, b.acts[1:5] AS acts, b.age_group, b.gender,
        t.hotel_id AS target_hotel_id
      FROM flagged b JOIN trained_items a ON b.hotels[-1] = a.hotel_id
      JOIN trained_items t ON a.location_name = t.location_name WHERE is_eligible = 1""",
    "predictions": """
      SELECT c.*, s.pred_action, s.prob, s.important_value
      FROM candidate_rows c JOIN item_scores s ON c.target_hotel_id = s.hotel_id""",
    "trend": """
      SELECT hotel_id, n_users, row_number() OVER (ORDER BY n_users DESC, hotel_id) AS rank FROM (
        SELECT hotel_id, count(DISTINCT raw_user_id) AS n_users FROM v_bookings JOIN items USING (hotel_code)
        WHERE CAST(updated_at + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2001-07-24' AND DATE '2001-07-31'
        GROUP BY 1) QUALIFY rank <= 10""",
    "trend_shown": """
      SELECT hotel_id, row_number() OVER (ORDER BY n_users DESC, hotel_id) AS rank FROM (
        SELECT hotel_id, count(DISTINCT raw_user_id) AS n_users FROM v_bookings JOIN items USING (hotel_code)
        WHERE CAST(updated_at + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2001-07-24' AND DATE '2001-07-31'
          AND hotel_id IN (SELECT hotel_id FROM shown_items) GROUP BY 1) QUALIFY rank <= 10""",
    "with_default": """
      SELECT 'default' AS user_id, hotel_id AS target_hotel_id, NULL AS gender,
        CAST(11 - rank AS DOUBLE) AS important_value FROM trend_shown
      UNION ALL SELECT user_id, target_hotel_id, gender, important_value FROM predictions""",
    "shown_items": """
      SELECT hotel_id FROM items JOIN v_hotel_profile p USING (hotel_code)
      WHERE display = 'Y' AND language = 'en'""",
    "ranked_shown": """
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY important_value DESC, target_hotel_id)
        AS rank FROM with_default WHERE target_hotel_id IN (SELECT hotel_id FROM shown_items)""",
    "lists": """
      SELECT coalesce(CAST(u.raw_user_id AS VARCHAR), r.user_id) AS user_id,
        list(CAST(i.hotel_code AS VARCHAR) ORDER BY rank) AS sv_playlist
      FROM ranked_shown r JOIN items i ON r.target_hotel_id = i.hotel_id
      LEFT JOIN users u ON r.user_id = u.user_id
      WHERE rank <= 10 AND (u.raw_user_id IS NOT NULL OR r.user_id = 'default') GROUP BY 1""",
    "served_lists": """
      SELECT CAST(c_custkey AS VARCHAR) AS user_id,
        coalesce(l.sv_playlist, (SELECT sv_playlist FROM lists WHERE user_id = 'default')) AS sv_playlist
      FROM customer LEFT JOIN lists l ON CAST(c_custkey AS VARCHAR) = l.user_id""",
    "prob_lists": """
      SELECT user_id, list(target_hotel_id ORDER BY rn) AS hotel_ids FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prob DESC, target_hotel_id) AS rn
        FROM predictions) WHERE rn <= 10 GROUP BY 1""",
    "bilingual": """
      SELECT hotel_code, location_code, city_code, country_code, image_url, rating, """
    + ", ".join(
        f"max({e}) FILTER (WHERE language = '{lang}') AS {lang}_{n}"
        for lang in ("en", "th")
        for n, e in (
            (
                "address",
                "trim(address1) || ' ' || trim(address2) || ' ' || trim(address3) || ' ' || trim(zipcode)",
            ),
            ("location_name", "trim(location_name)"),
            ("hotel_name", "trim(hotel_name)"),
            ("city_name", "trim(city_name)"),
            ("country_name", "trim(country_name)"),
        )
    )
    + " FROM v_hotel_profile GROUP BY 1, 2, 3, 4, 5, 6",
    "held_out": """
      SELECT u.user_id, u.gender, u.age_group, i.hotel_id, m.encoded_main_action AS main_action,
        e.event_timestamp
      FROM chain_runs e JOIN users u ON e.user_id = u.raw_user_id
      JOIN v_event_map m ON e.event_name = m.event_name LEFT JOIN items i ON e.hotel_code = i.hotel_code
      WHERE CAST(e.event_timestamp AS DATE) > DATE '2024-01-10' AND e.hotel_code IS NOT NULL
        AND m.encoded_main_action IS NOT NULL""",
    "skipped": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, hotel_id NULLS FIRST, main_action)
        AS place FROM held_out) WHERE place > 6""",
    "seen": """
      SELECT user_id, count(DISTINCT hotel_id) AS n_items FROM training GROUP BY 1
      HAVING count(DISTINCT hotel_id) >= 5""",
    "training_lists": f"""
      SELECT user_id, list(hotel_id ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS h,
        list(main_action ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS a,
        list({_code('main_action')} ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS c,
        list(complete_flag ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS f,
        list(duration ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS d, count(*) AS n
      FROM training GROUP BY 1 HAVING count(*) >= 6""",
    "window_starts": """
      SELECT user_id, s, row_number() OVER (PARTITION BY user_id ORDER BY s, tail) - 1 AS win FROM (
        SELECT user_id, unnest(range(0, n - 5, 5)) AS s, 0 AS tail FROM training_lists
        UNION ALL SELECT user_id, n - 6, 1 FROM training_lists)""",
    "windows": """
      SELECT w.user_id, w.win, h[s+1:s+6] AS h, a[s+1:s+6] AS a, c[s+1:s+6] AS c, f[s+1:s+6] AS f,
        d[s+1:s+6] AS d FROM window_starts w JOIN training_lists USING (user_id)""",
    "train_windows": """
      SELECT w.*, u.gender, u.age_group FROM windows w JOIN seen USING (user_id)
      LEFT JOIN users u ON w.user_id = u.user_id""",
    "v_raw_events": """
      SELECT strftime(ts, '%Y%m%d') AS event_date, ts AS event_timestamp, event_type AS event_name,
        CAST(user_id AS VARCHAR) AS user_id, CAST(user_id AS VARCHAR) || CAST(session AS VARCHAR) AS uid,
        session AS ga_session_id,
        CASE WHEN event_type <> 'purchase' OR value >= 5 THEN props->>'$.k' END AS hotel_id,
        'Hotel ' || (props->>'$.k') AS hotel_name,
        CASE WHEN value >= 20 THEN 'OTA Flight' WHEN event_type = 'error' THEN 'Other'
          WHEN event_type = 'signup' THEN 'ota' ELSE 'OTA Hotel' END AS content_group,
        CASE WHEN value < 10 THEN 'organic' ELSE 'ads' END AS first_touch_source,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS booking_id,
        CASE WHEN event_type = 'click' THEN 'c1' END AS carousel_id,
        CASE WHEN event_type = 'click' THEN 'Top picks' END AS carousel_name
      FROM (SELECT * REPLACE (user_id + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS user_id),
              CAST(strftime(ts, '%Y%m%d') AS BIGINT) + CASE WHEN copy = 1 THEN 1 ELSE 0 END AS session
            FROM events, (VALUES (0), (1), (2)) c(copy)
            WHERE copy = 0 OR (copy = 1 AND event_id % 11 = 0) OR (copy = 2 AND event_id % 13 = 0))
      WHERE value <= 45 AND NOT (event_type = 'error' AND value < 2)""",
    "unified": """
      SELECT DISTINCT * FROM v_raw_events
      WHERE lower(content_group) IN ('ota hotel', 'ota', 'ota flight')""",
    "marked_events": """
      SELECT *, CASE WHEN lag(event_name) OVER w = event_name THEN 0 ELSE 1 END AS starts FROM unified
      WHERE lower(content_group) IN ('ota', 'ota hotel')
      WINDOW w AS (PARTITION BY uid ORDER BY event_timestamp, event_name, hotel_id NULLS FIRST,
        booking_id NULLS FIRST)""",
    "run_spans": """
      SELECT uid, user_id, ga_session_id, run, first_touch_source, event_name, hotel_id, booking_id,
        carousel_id, min(event_timestamp) AS min_ts, max(event_timestamp) AS max_ts
      FROM (SELECT *, sum(starts) OVER (PARTITION BY uid ORDER BY event_timestamp, event_name,
              hotel_id NULLS FIRST, booking_id NULLS FIRST
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked_events)
      GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "runs": """
      SELECT *, date_sub('second', min_ts, max_ts) AS duration,
        coalesce(date_sub('second', max_ts, next_ts), 0) AS shift_duration,
        date_sub('second', min_ts, max_ts) + coalesce(date_sub('second', max_ts, next_ts), 0) AS total_duration
      FROM (SELECT *, lead(max_ts) OVER (PARTITION BY uid ORDER BY max_ts, run, event_name,
              hotel_id NULLS FIRST, booking_id NULLS FIRST, carousel_id NULLS FIRST,
              first_touch_source NULLS FIRST) AS next_ts FROM run_spans)""",
    "dated_users": """
      SELECT CAST(event_timestamp AS DATE) AS d, event_name, int_user_id
      FROM v_events e JOIN users u ON e.user_id = u.raw_user_id""",
    "booked_items": """
      SELECT CAST(l_orderkey AS VARCHAR) AS booking_id, CAST(min(l_partkey) AS VARCHAR) AS booking_hotel_id
      FROM lineitem GROUP BY l_orderkey""",
}

_LIST = "array_to_string"


def _history(tag: str, length: int, step: int, min_items: int) -> dict[str, str]:
    """Windows with their target, and their split, for one set of data parameters."""
    order = "ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration"
    at = f"s+1:s+{length}"
    bound = "CAST(floor(n * (1 - (0.15::DOUBLE + 0.15::DOUBLE)) - 1) AS BIGINT) + 1"
    return {
        f"keen_{tag}": f"""
          SELECT user_id FROM training GROUP BY 1 HAVING count(DISTINCT hotel_id) >= {min_items}""",
        f"event_lists_{tag}": f"""
          SELECT user_id, list(hotel_id {order}) AS h, list({_code('main_action')} {order}) AS c,
            list(style_name {order}) AS y, count(*) AS n FROM training GROUP BY 1 HAVING count(*) >= {length}""",
        f"starts_{tag}": f"""
          SELECT user_id, s, row_number() OVER (PARTITION BY user_id ORDER BY s, tail) - 1 AS win FROM (
            SELECT user_id, unnest(range(0, n - {length - 1}, {step})) AS s, 0 AS tail FROM event_lists_{tag}
            UNION ALL SELECT user_id, n - {length}, 1 FROM event_lists_{tag})""",
        f"hist_{tag}": f"""
          SELECT w.user_id, w.win, h[{at}] AS h, y[{at}] AS y, c[s+{length}] AS target, gender, age_group
          FROM starts_{tag} w JOIN event_lists_{tag} USING (user_id) JOIN keen_{tag} USING (user_id)
          LEFT JOIN users u ON w.user_id = u.user_id""",
        f"parts_{tag}": f"""
          SELECT * EXCLUDE (n, rn), CASE WHEN rn <= {bound} THEN 'train'
              WHEN rn <= {bound} + CAST(floor(n * 0.15::DOUBLE) AS BIGINT) THEN 'test' ELSE 'eval' END AS split
          FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY
              ((CAST(replace(user_id, 'user_', '') AS BIGINT) * 1000 + win) * 2654435761 + 42) % 2147483648,
              user_id, win) AS rn FROM hist_{tag})""",
    }


def _bayes(
    tag: str, train: str, rows: str, keys: str, length: int, user: bool = True, hotel: bool = True
) -> dict[str, str]:
    """Smoothed counts of ``train`` and the class logarithms of ``rows`` (lists h and y, gender, age_group)."""
    names = {"target_hotel_id": f"h[{length}]"} | {f"h{i}": f"h[{i}]" for i in range(1, length)}
    if hotel:
        names |= {"target_style": f"y[{length}]"} | {f"s{i}": f"y[{i}]" for i in range(1, length)}
    if user:
        names |= {"gender": "gender", "age_group": "age_group"}

    def long(source: str, columns: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {columns}, '{n}' AS name, coalesce(CAST({e} AS VARCHAR), 'unspecified') AS value FROM {source}"
            for n, e in names.items()
        )

    return {
        f"seen_{tag}": long(train, "target"),
        f"class_{tag}": f"""
          SELECT k, n, sum(n) OVER () AS total FROM (SELECT k, (SELECT count(*) FROM {train} WHERE target = k) AS n
            FROM range(6) r(k))""",
        f"logs_{tag}": f"""
          SELECT v.name, v.value, q.k, ln((coalesce(x.n, 0) + 1.0::DOUBLE) / (q.n + 1.0::DOUBLE * size)) AS lp
          FROM (SELECT DISTINCT name, value FROM seen_{tag}) v
          JOIN (SELECT name, count(DISTINCT value) AS size FROM seen_{tag} GROUP BY 1) z USING (name)
          CROSS JOIN class_{tag} q
          LEFT JOIN (SELECT name, value, target, count(*) AS n FROM seen_{tag} GROUP BY 1, 2, 3) x
            ON x.name = v.name AND x.value = v.value AND x.target = q.k""",
        f"asked_{tag}": long(rows, keys),
        f"sums_{tag}": f"""
          SELECT {keys}, q.k, round(sum(coalesce(lp, 0.0)) + ln((q.n + 1.0::DOUBLE) / (q.total + 6.0::DOUBLE)), 9) AS l
          FROM asked_{tag} a CROSS JOIN class_{tag} q
          LEFT JOIN logs_{tag} g ON g.name = a.name AND g.value = a.value AND g.k = q.k
          GROUP BY {keys}, q.k, q.n, q.total""",
        f"picked_{tag}": f"""
          SELECT {keys}, k AS pred, e / whole AS prob FROM (
            SELECT *, sum(e) OVER (PARTITION BY {keys}) AS whole, row_number() OVER (PARTITION BY {keys}
                ORDER BY l DESC, k) AS rn
            FROM (SELECT *, exp(l - max(l) OVER (PARTITION BY {keys})) AS e FROM sums_{tag})) WHERE rn = 1""",
    }


def _judged(tag: str, rows: str, by: str = "1") -> str:
    """n, accuracy and weighted F1 of the picks for ``rows``, for each ``by``."""
    return f"""
      SELECT part, CAST(sum(labelled) AS BIGINT) AS n, sum(hit) / sum(labelled) AS accuracy,
        sum(CASE WHEN labelled + guessed > 0 THEN labelled * 2.0::DOUBLE * hit / (labelled + guessed) ELSE 0 END)
          / sum(labelled) AS f1
      FROM (SELECT {by} AS part, k, count(*) FILTER (WHERE target = k) AS labelled,
              count(*) FILTER (WHERE pred = k) AS guessed,
              count(*) FILTER (WHERE target = k AND pred = k) AS hit
            FROM {rows} r JOIN picked_{tag} USING (user_id, win), range(6) t(k) GROUP BY 1, 2)
      GROUP BY 1"""


_SEARCH = [
    (tag, f"{tag}{m}", length, step, least, user, hotel)
    for tag, length, step, least in (("b", 4, 2, 4), ("a", 6, 5, 5))
    for m, (user, hotel) in enumerate(((True, True), (False, True), (True, False)))
]
for _tag, *_data in (("a", 6, 5, 5), ("b", 4, 2, 4)):
    VIEWS.update(_history(_tag, *_data))
    VIEWS[f"train_{_tag}"] = f"SELECT * FROM parts_{_tag} WHERE split = 'train'"
    VIEWS[f"eval_{_tag}"] = f"SELECT * FROM parts_{_tag} WHERE split = 'eval'"
for _tag, _trial, _length, _, _, _user, _hotel in _SEARCH:
    VIEWS.update(_bayes(_trial, f"train_{_tag}", f"eval_{_tag}", "user_id, win", _length, _user, _hotel))
VIEWS["held_parts"] = "SELECT * FROM parts_a WHERE split <> 'train'"
VIEWS.update(_bayes("held", "train_a", "held_parts", "user_id, win", 6))
VIEWS["offered"] = f"""
      SELECT c.user_id, c.target_hotel_id, list_append(hotels, c.target_hotel_id) AS h,
        [{", ".join(f"i{k}.style_name" for k in range(1, 7))}] AS y, c.gender, c.age_group
      FROM candidate_rows c {" ".join(f"LEFT JOIN items i{k} ON i{k}.hotel_id = hotels[{k}]" for k in range(1, 6))}
      LEFT JOIN items i6 ON i6.hotel_id = c.target_hotel_id"""
VIEWS.update(_bayes("all", "hist_a", "offered", "user_id, target_hotel_id", 6))



def _tree(tag: str, seen: str, asked: str, keys: str = "") -> dict[str, str]:
    """Class shares of the symbol lists ``asked`` by a tree of contexts counted over ``seen`` (symbols, target, n)."""
    by, own = (f"{keys}, ", f"a.{keys}, ") if keys else ("", "")
    same = f"a.{keys} = q.{keys} AND " if keys else ""
    counts = ", ".join(f"coalesce(sum(n) FILTER (WHERE target = {c}), 0)::DOUBLE" for c in range(6))
    return {
        f"nodes_{tag}": f"""
          SELECT {by}node, [{counts}] AS counts FROM (
            SELECT {by}target, n, symbols[1:d] AS node FROM (SELECT *, unnest(range(0, len(symbols) + 1)) AS d FROM {seen}))
          GROUP BY {by}node""",
        f"way_{tag}": f"""
          SELECT {own}a.symbols, list(coalesce(counts, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[]) ORDER BY d) AS way
          FROM (SELECT *, unnest(range(0, len(symbols) + 1)) AS d FROM (SELECT DISTINCT {by}symbols FROM {asked})) a
          LEFT JOIN nodes_{tag} q ON {same}q.node = a.symbols[1:a.d] GROUP BY {own}a.symbols""",
        f"shares_{tag}": f"""
          SELECT {by}symbols, list_position(p, list_max(p)) - 1 AS pred, list_max(p) AS prob FROM (
            SELECT {by}symbols, list_reduce(
              list_prepend([1.0::DOUBLE / 6, 1.0::DOUBLE / 6, 1.0::DOUBLE / 6, 1.0::DOUBLE / 6, 1.0::DOUBLE / 6, 1.0::DOUBLE / 6], way),
              lambda p, n: CASE WHEN list_sum(n) = 0 THEN p ELSE list_transform(list_zip(p, n), lambda z:
                (z[2] + len(list_filter(n, lambda x: x > 0))::DOUBLE * z[1])
                  / (list_sum(n) + len(list_filter(n, lambda x: x > 0))::DOUBLE)) END) AS p FROM way_{tag})""",
    }


_SYMBOLS = """list_prepend(coalesce({style}, 'unspecified'),
    list_transform(list_reverse({past}), lambda x: coalesce(CAST(x AS VARCHAR), 'unspecified')))"""
VIEWS["order_rows"] = f"""
      SELECT w.user_id, w.win, split, {_SYMBOLS.format(style='e.y[s+6]', past='e.c[s+1:s+5]')} AS symbols, e.c[s+6] AS target, 1 AS n
      FROM starts_a w JOIN event_lists_a e ON e.user_id = w.user_id JOIN parts_a p ON p.user_id = w.user_id AND p.win = w.win"""
VIEWS["order_train"] = "SELECT * FROM order_rows WHERE split = 'train'"
VIEWS["order_held"] = "SELECT * FROM order_rows WHERE split <> 'train'"
VIEWS.update(_tree("held_order", "order_train", "order_held"))
VIEWS["order_offered"] = f"""
      SELECT user_id, target_hotel_id, {_SYMBOLS.format(style='style_name', past='acts')} AS symbols
      FROM candidate_rows JOIN items ON hotel_id = target_hotel_id"""
VIEWS.update(_tree("all_order", "order_rows", "order_offered"))

# Twenty-seven of the 210 combinations, every eleventh, counted round.
_SPACE = [(a, b, c, t) for a in range(4, 11) for b in (1, 2, 5) for c in range(4, 9) for t in ("true", "false")]
_DRAWN = [(i, *_SPACE[i * 11 % 210]) for i in range(27)]
VIEWS["search_cands"] = "SELECT * FROM (VALUES " + ", ".join(str(c).replace("'", "") for c in _DRAWN) + ") t(cand, seq_len, step, min_seen, with_style)"
VIEWS["search_places"] = f"""
      SELECT user_id, style_name, {_code('main_action')} AS target, row_number() OVER u - 1 AS place,
        count(*) OVER (PARTITION BY user_id) AS n_events,
        list_reverse(coalesce(list({_code('main_action')}) OVER (PARTITION BY user_id ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration
          ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING), [])) AS past,
        (CAST(replace(user_id, 'user_', '') AS BIGINT) * 2654435761 + 42) % 2147483648 AS mark
      FROM training WINDOW u AS (PARTITION BY user_id ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration)"""
VIEWS["search_seen"] = "SELECT user_id, count(DISTINCT hotel_id) AS n_items FROM training GROUP BY 1"
VIEWS["search_examples"] = """
      SELECT cand, mark % 9 AS part, (mark // 9) % 5 = 0 AS held, target, 1 AS n,
        list_concat(CASE WHEN with_style THEN [coalesce(style_name, 'unspecified')] ELSE []::VARCHAR[] END,
          list_transform(past[1:seq_len-1], lambda x: CAST(x AS VARCHAR))) AS symbols
      FROM search_places JOIN search_seen USING (user_id) JOIN search_cands ON n_items >= min_seen
        AND place >= seq_len - 1 AND ((place - seq_len + 1) % step = 0 OR place = n_events - 1)"""
VIEWS["alive_1"] = "SELECT cand FROM search_cands"
for _round, (_parts, _keep) in enumerate(((1, 9), (3, 3), (9, 1)), 1):
    VIEWS[f"sample_{_round}"] = f"SELECT e.* FROM search_examples e JOIN alive_{_round} USING (cand) WHERE part < {_parts}"
    VIEWS[f"fitted_{_round}"] = f"SELECT * FROM sample_{_round} WHERE NOT held"
    VIEWS[f"probe_{_round}"] = f"SELECT * FROM sample_{_round} WHERE held"
    VIEWS.update(_tree(f"round_{_round}", f"fitted_{_round}", f"probe_{_round}", "cand"))
    VIEWS[f"ranking_{_round}"] = f"""
      SELECT {_round} AS round, *, row_number() OVER (ORDER BY accuracy DESC, cand) AS rank FROM (
        SELECT cand, count(pred) AS n, coalesce(count(*) FILTER (WHERE pred = target) / nullif(count(pred), 0), 0.0) AS accuracy
        FROM alive_{_round} LEFT JOIN (SELECT p.cand, p.target, s.pred FROM probe_{_round} p
          JOIN shares_round_{_round} s ON s.cand = p.cand AND s.symbols = p.symbols) USING (cand) GROUP BY cand)"""
    VIEWS[f"alive_{_round + 1}"] = f"SELECT cand FROM ranking_{_round} WHERE rank <= {_keep}"

ORACLES: dict[str, str] = {
    "normalise_location": "SELECT hotel_code, location_name, style_name FROM v_items0",
    "booking_action": """
      SELECT main_action, count(*) AS n_bookings, count(DISTINCT raw_user_id) AS n_users,
        count(DISTINCT hotel_code) AS n_hotels, max(price) AS max_price FROM v_bookings GROUP BY 1""",
    "json_path_extract": """
      SELECT hotel_code, count(*) AS n_bookings, count(DISTINCT raw_user_id) AS n_users
      FROM v_bookings GROUP BY 1""",
    "booking_details": """
      SELECT l_linestatus AS room_type, l_returnflag AS status, count(*) AS n,
        CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS n_rooms,
        CAST(max(l_linenumber) AS BIGINT) AS max_days, max(l_extendedprice) AS max_price,
        max(l_discount) AS max_discount FROM v_bookings GROUP BY 1, 2""",
    "quarantined_documents": """
      SELECT 'bookings' AS load, CASE WHEN booking_id % 2 = 0 THEN 'request,details' ELSE 'details' END AS reason,
        count(*) AS n, 20::BIGINT AS longest FROM v_bookings WHERE booking_id % 97 = 0 GROUP BY 1, 2
      UNION ALL SELECT 'events', 'props', count(*), 3::BIGINT FROM events WHERE event_id % 89 = 0""",
    "encode_actions": f"""
      SELECT coalesce(CAST({_code('event_name')} AS VARCHAR), event_name) AS passed_through,
        CAST(coalesce({_code('main_action')}, -1) AS BIGINT) AS code, count(*) AS n
      FROM v_events LEFT JOIN v_event_map USING (event_name) GROUP BY 1, 2""",
    "decode_actions": f"""
      SELECT coalesce({_name('encoded_main_action')}, 'none') AS main_action, count(*) AS n
      FROM v_events JOIN v_event_map USING (event_name) GROUP BY 1""",
    "fill_defaults": """
      SELECT '2024-01-31' AS run_date, style_name, count(*) AS n_items FROM v_items0 GROUP BY 1, 2""",
    "star_except": """
      SELECT * EXCLUDE (latitude, longitude, location_name), location_name AS location FROM items""",
    "event_range_filter": """
      SELECT event_id, epoch_us(event_timestamp + INTERVAL 7 HOUR) AS local_us,
        CAST(CAST(event_timestamp + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS local_day FROM v_events
      WHERE CAST(event_timestamp + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
        AND CAST(event_timestamp AS DATE) > DATE '2024-01-10' AND event_name <> 'error'
        AND hotel_code IS NOT NULL""",
    "parameterised_scan": """
      SELECT event_name, count(*) AS n, min(event_id) AS first_id FROM v_events
      WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' GROUP BY 1""",
    "inner_lookup": """
      SELECT hotel_id, event_name, count(*) AS n FROM v_events JOIN v_event_map USING (event_name)
      JOIN items USING (hotel_code) GROUP BY 1, 2""",
    "left_lookup": """
      SELECT event_name, coalesce(main_action, 'none') AS main_action, count(*) AS n
      FROM v_events LEFT JOIN v_event_map USING (event_name) GROUP BY 1, 2""",
    "cast_key_join": """
      SELECT location_name, count(*) AS n_bookings, count(DISTINCT raw_user_id) AS n_users
      FROM v_bookings b JOIN items i ON CAST(b.hotel_code AS VARCHAR) = CAST(i.hotel_code AS VARCHAR)
      GROUP BY 1""",
    "left_join_filtered_right": """
      SELECT h.city_name, CAST(h.rating AS BIGINT) AS rating, count(*) AS n_predictions,
        count(DISTINCT p.user_id) AS n_users
      FROM predictions p LEFT JOIN items i ON p.target_hotel_id = i.hotel_id
      LEFT JOIN v_hotel_profile h ON i.hotel_code = h.hotel_code
      WHERE h.display = 'Y' AND h.language = 'en' GROUP BY 1, 2""",
    "location_expansion": """
      SELECT a.location_name, count(*) AS n, count(DISTINCT b.raw_user_id) AS n_users
      FROM (SELECT DISTINCT raw_user_id, hotel_code FROM v_bookings) b
      JOIN items a ON b.hotel_code = a.hotel_code
      JOIN trained_items t ON a.location_name = t.location_name GROUP BY 1""",
    "trained_users_semi": """
      SELECT raw_user_id, user_id FROM users WHERE user_id IN (SELECT user_id FROM training)""",
    "new_users_anti": """
      SELECT raw_user_id, CAST(max(register_date) AS VARCHAR) AS register_date FROM v_customer_profile
      WHERE raw_user_id NOT IN (SELECT raw_user_id FROM existing_users) GROUP BY 1""",
    "latest_action_per_pair": """
      SELECT raw_user_id, hotel_code, main_action, epoch_us(event_timestamp) AS event_timestamp
      FROM app_latest""",
    "union_events": """
      SELECT raw_user_id, main_action, count(*) AS n, count(DISTINCT hotel_code) AS n_items,
        epoch_us(max(event_timestamp)) AS last_us FROM all_events GROUP BY 1, 2""",
    "repeat_visits": """
      SELECT raw_user_id, count(*) AS n, count(prev) AS n_repeats,
        count(CASE WHEN hotel_code = prev OR prev IS NULL THEN hotel_code END) AS n_kept
      FROM (SELECT *, lag(hotel_code) OVER (PARTITION BY raw_user_id, hotel_code
              ORDER BY event_timestamp, main_action) AS prev FROM all_events) GROUP BY 1""",
    "recent_behaviour": f"""
      SELECT user_id, {_LIST}(hotels, ',') AS hotel_id_sequence, {_LIST}(acts, ',') AS main_action_sequence,
        age_group, gender FROM behaviour""",
    "daily_behaviour": f"""
      SELECT user_id, {_LIST}(hotels, ',') AS hotel_id_sequence, {_LIST}(acts, ',') AS main_action_sequence,
        age_group, gender FROM behaviour""",
    "earliest_behaviour": f"""
      SELECT user_id, {_LIST}(list(hotel_id ORDER BY rn), ',') AS hotel_id_sequence,
        {_LIST}(list(main_action ORDER BY rn), ',') AS main_action_sequence,
        any_value(age_group) AS age_group, any_value(gender) AS gender
      FROM (SELECT *, row_number() OVER (PARTITION BY raw_user_id ORDER BY event_timestamp,
              hotel_id, main_action) AS rn FROM coded_events)
      JOIN users USING (raw_user_id) WHERE rn <= 6 GROUP BY user_id""",
    "eligibility_split": """
      SELECT user_id, CAST(len(hotels) AS BIGINT) AS n_events, CAST(is_eligible AS BIGINT) AS is_eligible
      FROM flagged""",
    "eligibility_counts": """
      SELECT count(*) FILTER (WHERE is_eligible = 1) AS n_eligible,
        count(*) FILTER (WHERE is_eligible = 0) AS n_cold_start FROM flagged""",
    "eligibility_disjoint": """
      SELECT count(*) AS n_shared FROM flagged WHERE is_eligible = 0
        AND user_id IN (SELECT user_id FROM flagged WHERE is_eligible = 1)""",
    "time_range": """
      SELECT epoch_us(min(event_timestamp)) AS first, epoch_us(max(event_timestamp)) AS last FROM training""",
    "distinct_users": """
      SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT hotel_id) AS n_items FROM training""",
    "null_profile": """
      SELECT count(*) AS n_rows, count(*) FILTER (WHERE gender IS NULL) AS gender_nulls,
        count(*) FILTER (WHERE age IS NULL) AS age_nulls,
        count(*) FILTER (WHERE age_group IS NULL) AS age_group_nulls,
        count(*) FILTER (WHERE register_date IS NULL) AS register_date_nulls FROM users""",
    "top_locations": """
      SELECT location_name, count(*) AS n FROM items GROUP BY 1 ORDER BY n DESC, location_name LIMIT 3""",
    "action_distribution": "SELECT main_action, count(*) AS n FROM training GROUP BY 1",
    "latest_profile": """
      SELECT raw_user_id, CAST(register_date AS VARCHAR) AS register_date,
        CAST(birth_date AS VARCHAR) AS birth_date, gender FROM latest_profiles""",
    "median_by_gender": "SELECT gender, median_age FROM medians",
    "user_surrogate_ids": """
      SELECT raw_user_id, int_user_id, user_id FROM users
      WHERE raw_user_id NOT IN (SELECT raw_user_id FROM existing_users)""",
    "item_surrogate_ids": "SELECT hotel_code, int_hotel_id FROM items",
    "age_bucket": f"""
      SELECT raw_user_id, age, age - CASE WHEN month(birth_date) > 1 OR (month(birth_date) = 1
          AND day(birth_date) > 31) THEN 1 ELSE 0 END AS literal_age,
        {_bins('age', 1)} AS age_group_label, {_bins('age', 2)} AS age_group
      FROM (SELECT *, date_sub('year', birth_date, DATE '2024-01-31') AS age FROM latest_profiles)
      WHERE age IS NOT NULL""",
    "impute_age": """
      SELECT f.raw_user_id, f.gender,
        coalesce(CAST(date_sub('year', birth_date, DATE '2024-01-31') AS DOUBLE), median_age) AS age
      FROM fresh_users f LEFT JOIN medians m ON f.gender = m.gender""",
    "user_dim": """
      SELECT raw_user_id, int_user_id, user_id, gender, age,
        CAST(register_date AS VARCHAR) AS register_date, CAST(busi_dt AS VARCHAR) AS busi_dt,
        age_group_label, age_group FROM users""",
    "item_dim": f"""
      SELECT hotel_code, int_hotel_id, hotel_id, i.location_name, i.style_name,
        round(CAST(CAST(latitude AS FLOAT) AS DOUBLE), 3) AS latitude,
        round(CAST(CAST(longitude AS FLOAT) AS DOUBLE), 3) AS longitude,
        s.hot AS style_onehot, l.hot AS location_onehot, '2024-01-31' AS run_date
      FROM items i
      JOIN (SELECT v.style_name, {_LIST}(list(CASE WHEN v.index = w.index THEN 1 ELSE 0 END
              ORDER BY w.index), ',') AS hot FROM style_vocab v, style_vocab w GROUP BY 1) s
        ON i.style_name = s.style_name
      JOIN (SELECT v.location_name, {_LIST}(list(CASE WHEN v.index = w.index THEN 1 ELSE 0 END
              ORDER BY w.index), ',') AS hot FROM location_vocab v, location_vocab w GROUP BY 1) l
        ON i.location_name = l.location_name""",
    "vocabulary": "SELECT style_name, index FROM style_vocab",
    "one_hot_style": """
      SELECT hotel_id, v.index AS style_name_index, n AS style_name_size,
        repeat('0', CAST(v.index AS BIGINT)) || '1' || repeat('0', CAST(n - v.index - 1 AS BIGINT)) AS onehot
      FROM items JOIN style_vocab v USING (style_name), (SELECT count(*) AS n FROM style_vocab)""",
    "one_hot_wide": """
      SELECT 'style_' || style_name AS feature, count(hotel_id) AS n_items
      FROM style_vocab LEFT JOIN items USING (style_name) GROUP BY 1
      UNION ALL
      SELECT CASE WHEN location_name = 'unspecified' THEN 'location_unspecified' ELSE location_name END,
        count(hotel_id) FROM location_vocab LEFT JOIN items USING (location_name) GROUP BY 1""",
    "seen_min_distinct": "SELECT user_id, n_items FROM seen",
    "sliding_windows": f"""
      SELECT user_id, win, {_LIST}(h, ',') AS hotel_id_sequence, {_LIST}(a, ',') AS main_action_sequence
      FROM windows""",
    "training_sequences": f"""
      SELECT user_id, win, {_LIST}(h, ',') AS hotel_id_sequence, {_LIST}(c, ',') AS main_action_sequence,
        {_LIST}(f, ',') AS complete_flag_sequence, {_LIST}(d, ',') AS duration_sequence, gender, age_group
      FROM train_windows""",
    "history_target": f"""
      SELECT user_id, win, {_LIST}(h[1:5], ',') AS sequence_hotel_ids,
        {_LIST}(c[1:5], ',') AS main_action_sequence, h[6] AS target_hotel_id,
        CAST(c[6] AS BIGINT) AS target FROM train_windows""",
    "hash_split": """
      SELECT user_id, win, CASE WHEN rn <= CAST(floor(n * (1 - (0.15::DOUBLE + 0.15::DOUBLE)) - 1) AS BIGINT) + 1 THEN 'train'
          WHEN rn <= CAST(floor(n * (1 - (0.15::DOUBLE + 0.15::DOUBLE)) - 1) AS BIGINT) + 1
            + CAST(floor(n * 0.15::DOUBLE) AS BIGINT) THEN 'test' ELSE 'eval' END AS split
      FROM (SELECT user_id, win, count(*) OVER () AS n, row_number() OVER (ORDER BY
              ((CAST(replace(user_id, 'user_', '') AS BIGINT) * 1000 + win) * 2654435761 + 42) % 2147483648,
              user_id, win) AS rn FROM train_windows)""",
    "user_split": """
      SELECT w.user_id, w.win, CASE WHEN rn <= CAST(floor(n * (1 - (0.15::DOUBLE + 0.15::DOUBLE)) - 1) AS BIGINT) + 1 THEN 'train'
          WHEN rn <= CAST(floor(n * (1 - (0.15::DOUBLE + 0.15::DOUBLE)) - 1) AS BIGINT) + 1
            + CAST(floor(n * 0.15::DOUBLE) AS BIGINT) THEN 'test' ELSE 'eval' END AS split
      FROM train_windows w JOIN (
        SELECT user_id, count(*) OVER () AS n, row_number() OVER (ORDER BY
          CAST(replace(user_id, 'user_', '') AS BIGINT) * 2654435761 % 2147483648, user_id) AS rn
        FROM (SELECT DISTINCT user_id FROM train_windows)) u ON w.user_id = u.user_id""",
    "kway_split": """
      SELECT user_id, win, least(CAST(ceil(rn / (n // 7)) AS BIGINT), 7) AS part
      FROM (SELECT user_id, win, count(*) OVER () AS n, row_number() OVER (ORDER BY user_id, win) AS rn
            FROM train_windows)""",
    "candidates": f"""
      SELECT user_id, {_LIST}(hotels, ',') AS hotel_id_sequence, {_LIST}(acts, ',') AS main_action_sequence,
        age_group, gender, target_hotel_id FROM candidate_rows""",
    "score_empirical": """
      SELECT user_id, target_hotel_id, CAST(pred_action AS BIGINT) AS pred_action,
        round(prob, 6) AS prob, round(important_value, 6) AS important_value FROM predictions""",
    "trending": "SELECT hotel_id, n_users, rank FROM trend",
    "trending_by_days": "SELECT hotel_id, n_users, rank FROM trend",
    "weekly_reach": """
      SELECT CAST(until AS VARCHAR) AS until, event_name, count(DISTINCT int_user_id) AS reach
      FROM (SELECT CAST(unnest(range(min(d), max(d) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS until FROM dated_users)
      JOIN dated_users ON d BETWEEN until - 6 AND until GROUP BY 1, 2""",
    "union_missing_cols": """
      SELECT user_id, target_hotel_id, gender, round(important_value, 6) AS important_value FROM with_default""",
    "rank_per_user": """
      SELECT user_id, target_hotel_id, row_number() OVER (PARTITION BY user_id
        ORDER BY important_value DESC, target_hotel_id) AS rank FROM predictions""",
    "topk_per_user": """
      SELECT user_id, target_hotel_id, row_number() OVER (PARTITION BY user_id
        ORDER BY important_value DESC, target_hotel_id) AS rank FROM with_default QUALIFY rank <= 3""",
    "playlist": f"SELECT user_id, {_LIST}(sv_playlist, ',') AS sv_playlist FROM lists",
    "playlist_all_items": f"""
      SELECT coalesce(CAST(u.raw_user_id AS VARCHAR), r.user_id) AS user_id,
        {_LIST}(list(CAST(i.hotel_code AS VARCHAR) ORDER BY rank), ',') AS sv_playlist
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY important_value DESC, target_hotel_id)
              AS rank FROM with_default) r
      JOIN items i ON r.target_hotel_id = i.hotel_id LEFT JOIN users u ON r.user_id = u.user_id
      WHERE rank <= 10 GROUP BY 1""",
    "playlist_from_probs": f"SELECT user_id, {_LIST}(hotel_ids, ',') AS hotel_ids FROM prob_lists",
    "predictable_pairs": """
      SELECT DISTINCT u.user_id, i.hotel_id AS target_hotel_id FROM v_bookings b
      JOIN users u ON b.raw_user_id = u.raw_user_id JOIN items i ON b.hotel_code = i.hotel_code
      WHERE u.user_id IN (SELECT user_id FROM training) AND i.hotel_id IN (SELECT hotel_id FROM training)""",
    "bilingual_pivot": "SELECT * REPLACE (CAST(rating AS BIGINT) AS rating) FROM bilingual",
    "serving_profile": """
      SELECT * REPLACE (CAST(rating AS BIGINT) AS rating) FROM bilingual WHERE hotel_code IN (
        SELECT hotel_code FROM items WHERE hotel_id IN (
          SELECT target_hotel_id FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY important_value DESC, target_hotel_id)
              AS rank FROM with_default WHERE target_hotel_id IN (SELECT hotel_id FROM shown_items))
          WHERE rank <= 10))""",
    "entries_without_profile": """
      SELECT count(*) AS n_entries, count(*) FILTER (WHERE code NOT IN (
          SELECT CAST(hotel_code AS VARCHAR) FROM items WHERE hotel_id IN (
            SELECT target_hotel_id FROM ranked_shown WHERE rank <= 10))) AS n_unknown
      FROM (SELECT unnest(sv_playlist) AS code FROM lists)""",
    "list_lengths": """
      SELECT CASE WHEN user_id = 'default' THEN 'default' ELSE 'own' END AS owner,
        CAST(len(sv_playlist) AS BIGINT) AS n_items, count(*) AS n_lists FROM lists GROUP BY 1, 2""",
    "default_fallback": f"SELECT user_id, {_LIST}(sv_playlist, ',') AS sv_playlist FROM served_lists",
    "serve_requests": """
      SELECT r.user_id, r.pos, r.code AS hotel_id, coalesce(b.en_hotel_name, '') AS name_en,
        coalesce(b.th_hotel_name, '') AS name_th, coalesce(b.en_address, '') AS address_en,
        coalesce(b.location_code, '') AS location_id, coalesce(b.th_city_name, '') AS city_th,
        coalesce(CAST(b.rating AS DOUBLE), 0.0) AS rating, CAST(5 AS DOUBLE) AS score,
        CAST(100 AS BIGINT) AS n_reviews, CAST(0 AS BIGINT) AS n_promotions,
        coalesce(b.image_url, '') AS image
      FROM (SELECT user_id, unnest(sv_playlist) AS code,
              CAST(unnest(range(0, len(sv_playlist))) AS BIGINT) AS pos FROM served_lists) r
      LEFT JOIN bilingual b ON CAST(r.code AS BIGINT) = b.hotel_code""",
    "action_pivot": "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE pred_action = {c}) AS {a}" for a, c in ACTION_CODES.items())
    + " FROM predictions GROUP BY 1",
    "user_segments": """
      SELECT user_id, CASE WHEN count(*) FILTER (WHERE pred_action IN (2, 3, 5)) > 0
        THEN 'promising' ELSE 'ordinary' END AS segment FROM predictions GROUP BY 1""",
    "skip_first_n": "SELECT user_id, epoch_us(event_timestamp) AS event_timestamp, hotel_id, place FROM skipped",
    "collapse_repeats": "__COLLAPSE(held_out)__SELECT user_id, run, hotel_id, main_action FROM collapsed",
    "holdout": """__COLLAPSE(skipped)__SELECT user_id, gender, age_group, run, hotel_id, main_action
      FROM collapsed""",
    "hits_at_n": """__COLLAPSE(skipped)__
      SELECT p.user_id, CASE WHEN len(actual) >= 10
          THEN CAST(len(list_intersect(hotel_ids, actual)) AS VARCHAR) ELSE 'none' END AS hits
      FROM prob_lists p JOIN (SELECT user_id, list(hotel_id ORDER BY run) AS actual FROM collapsed
        WHERE run <= 10 GROUP BY 1) USING (user_id)""",
    "topk_history": f"""
      SELECT p.user_id, {_LIST}(hotel_ids, ',') AS hotel_ids, {_LIST}(f.hotels[1:4], ',') AS history
      FROM prob_lists p LEFT JOIN flagged f USING (user_id)""",
    "carousel_events": """
      SELECT DISTINCT event_date, epoch_us(event_timestamp) AS event_timestamp, event_name, uid, hotel_id,
        hotel_name, carousel_id, carousel_name FROM v_raw_events WHERE event_name = 'click'""",
    "unified_events": """
      SELECT epoch_us(event_timestamp) AS event_timestamp, event_name, uid, content_group,
        first_touch_source, hotel_id, booking_id, carousel_id FROM unified""",
    "incremental_events": """
      SELECT event_date, count(*) AS n, count(DISTINCT uid) AS n_sessions FROM unified
      WHERE CAST(event_timestamp AS DATE) > DATE '2024-01-10' GROUP BY 1""",
    "event_runs": """
      SELECT uid, event_name, duration, shift_duration, total_duration, hotel_id, booking_id, carousel_id,
        epoch_us(min_ts) AS min_event_timestamp, epoch_us(max_ts) AS max_event_timestamp FROM runs""",
    "daily_event_runs": """
      SELECT uid, event_name, duration, shift_duration, total_duration, hotel_id, booking_id, carousel_id,
        epoch_us(min_ts) AS min_event_timestamp, epoch_us(max_ts) AS max_event_timestamp FROM runs""",
    "stream_events": """
      SELECT epoch_us(event_timestamp) AS event_timestamp, event_name, uid, content_group,
        first_touch_source, hotel_id, booking_id, carousel_id FROM unified""",
    "late_events": """
      SELECT event_date, event_name, count(*) AS n, count(DISTINCT uid) AS n_sessions FROM v_raw_events
      WHERE event_name = 'click' AND CAST(event_timestamp AS DATE) <= DATE '2024-01-02' GROUP BY 1, 2""",
    "upstream_report": """
      SELECT event_date, hotel_id, first_touch_source, """
    + ", ".join(
        f"CAST(coalesce(sum({m}) FILTER (WHERE upstream_event_tag = '{t}'), 0) AS BIGINT) AS {t}_{m}"
        for t in UPSTREAM_TAGS
        for m in ("impression", "reach")
    )
    + """ FROM (SELECT event_date, event_timestamp, event_name, hotel_id, hotel_name, first_touch_source,
            upstream_event_tag, count(DISTINCT uid) AS impression, count(DISTINCT user_id) AS reach
          FROM v_raw_events JOIN v_event_map USING (event_name)
          WHERE upstream_event_tag <> 'N' AND hotel_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7)
        GROUP BY 1, 2, 3""",
    "training_events": """
      SELECT user_id, main_action, hotel_id, duration, complete_flag, epoch_us(event_timestamp) AS event_timestamp
      FROM training""",
    "ml_score": """
      SELECT user_id, target_hotel_id, CAST(pred AS BIGINT) AS pred_action, round(prob, 6) AS prob,
        round(pred * prob, 6) AS important_value FROM picked_all""",
    "ml_unseen_values": """
      SELECT name, count(*) AS n, count(*) FILTER (WHERE known IS NULL) AS n_unseen
      FROM asked_held LEFT JOIN (SELECT DISTINCT name, value, 1 AS known FROM seen_held) USING (name, value) GROUP BY 1""",
    "ml_topk": """
      SELECT user_id, rank, target_hotel_id, CAST(pred AS BIGINT) AS pred_action, round(prob, 6) AS prob,
        round(pred * prob, 6) AS important_value
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(pred * prob, 9) DESC, target_hotel_id) AS rank
            FROM picked_all) WHERE rank <= 10""",
    "ml_score_ordered": """
      SELECT user_id, target_hotel_id, CAST(pred AS BIGINT) AS pred_action, round(prob, 6) AS prob,
        round(pred * prob, 6) AS important_value FROM order_offered o JOIN shares_all_order s ON s.symbols = o.symbols""",
    "ml_metrics_ordered": """
      SELECT split, CAST(sum(labelled) AS BIGINT) AS n, round(sum(hit) / sum(labelled), 6) AS accuracy,
        round(sum(CASE WHEN labelled + guessed > 0 THEN labelled * 2.0::DOUBLE * hit / (labelled + guessed) ELSE 0 END)
          / sum(labelled), 6) AS f1
      FROM (SELECT split, k, count(*) FILTER (WHERE target = k) AS labelled, count(*) FILTER (WHERE pred = k) AS guessed,
              count(*) FILTER (WHERE target = k AND pred = k) AS hit
            FROM order_held h JOIN shares_held_order s ON s.symbols = h.symbols, range(6) t(k) GROUP BY 1, 2)
      GROUP BY 1""",
    "halving_search": """
      SELECT round::BIGINT AS round, cand::BIGINT AS cand, seq_len::BIGINT AS seq_len, step::BIGINT AS step,
        min_seen::BIGINT AS min_seen, with_style, n::BIGINT AS n, round(accuracy, 6) AS accuracy, rank, survived
      FROM (SELECT *, rank <= 9 AS survived FROM ranking_1 UNION ALL SELECT *, rank <= 3 FROM ranking_2
            UNION ALL SELECT *, rank <= 1 FROM ranking_3) JOIN search_cands USING (cand)""",
    "ml_metrics": f"""
      SELECT part AS split, n, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1
      FROM ({_judged('held', 'held_parts', 'split')})""",
    "ml_class_distribution": f"""
      SELECT {_name('pred')} AS main_action, count(*) AS n FROM picked_held
      JOIN held_parts USING (user_id, win) WHERE split = 'test' GROUP BY 1""",
    "param_search": """
      SELECT *, row_number() OVER (ORDER BY round(accuracy, 9) DESC, round(f1, 9) DESC, seq_len, step,
          min_seen, user_features, hotel_features) AS rank FROM (
        SELECT seq_len, step, min_seen, user_features, hotel_features, round(accuracy, 6) AS accuracy,
          round(f1, 6) AS f1 FROM ("""
    + " UNION ALL ".join(
        f"SELECT {length}::BIGINT AS seq_len, {step}::BIGINT AS step, {least}::BIGINT AS min_seen,"
        f" {user} AS user_features, {hotel} AS hotel_features, accuracy, f1"
        f" FROM ({_judged(name, f'eval_{tag}')})"
        for tag, name, length, step, least, user, hotel in _SEARCH
    )
    + "))",
    "observed_profile": """
      SELECT count(*) AS n_rows, count(*) FILTER (WHERE gender IS NULL) AS gender_nulls,
        count(*) FILTER (WHERE age IS NULL) AS age_nulls, count(*) FILTER (WHERE age_group IS NULL) AS age_group_nulls,
        count(*) FILTER (WHERE register_date IS NULL) AS register_date_nulls,
        CAST(min(register_date) AS VARCHAR) AS first_register_date, CAST(max(register_date) AS VARCHAR) AS last_register_date
      FROM users""",
    "csv_roundtrip": f"""
      SELECT w.user_id, w.win, {_LIST}(h[s+1:s+6], ',') AS hotel_id_sequence,
        {_LIST}(a[s+1:s+6], ',') AS main_action_sequence, '\\E' AS notes
      FROM window_starts w JOIN (
        SELECT user_id, list(CASE WHEN style_name <> 'unspecified' THEN hotel_id END
            ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS h,
          list(main_action ORDER BY event_timestamp, hotel_id, action_code, complete_flag, duration) AS a
        FROM training GROUP BY 1) l ON w.user_id = l.user_id""",
    "append_evolve": """
      SELECT u.raw_user_id, u.user_id, CASE WHEN e.raw_user_id IS NULL THEN u.gender END AS gender
      FROM users u LEFT JOIN existing_users e ON u.raw_user_id = e.raw_user_id""",
    "overwrite_schema": "SELECT hotel_id, location_name, style_name FROM items",
    "feature_upsert": """
      SELECT b.hotel_code, CAST(CASE WHEN s.hotel_id IS NULL THEN b.rating ELSE 9 END AS BIGINT) AS rating,
        b.en_hotel_name,
        CASE WHEN s.hotel_id IS NOT NULL THEN i.location_name END AS location_name
      FROM bilingual b JOIN items i ON b.hotel_code = i.hotel_code
      LEFT JOIN shown_items s ON i.hotel_id = s.hotel_id""",
    "publish_snapshot": """
      SELECT hotel_id, en_hotel_name, th_city_name FROM items JOIN bilingual USING (hotel_code)""",
}


ORACLES["resumed_export"] = ORACLES["csv_roundtrip"]


def _collapsed(source: str) -> dict[str, str]:
    return {
        # Equal rows keep one order in both windows below.
        "placed": f"""
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, hotel_id NULLS FIRST, main_action) AS pos
          FROM {source} WHERE gender IS NOT NULL AND age_group IS NOT NULL""",
        "marked": """
          SELECT *, CASE WHEN hotel_id = lag(hotel_id) OVER (PARTITION BY user_id ORDER BY pos) THEN 0 ELSE 1 END AS starts
          FROM placed""",
        "collapsed": """
          SELECT user_id, gender, age_group, run, arg_min(hotel_id, pos) AS hotel_id,
            CAST(max(main_action) AS BIGINT) AS main_action
          FROM (SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM marked)
          GROUP BY 1, 2, 3, 4""",
    }


def _needed(sql: str, views: dict[str, str]) -> list[str]:
    """Names of the views ``sql`` builds on, each after the ones it needs itself."""
    found: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"\b[a-z_0-9]+\b", text))
        for name in views:
            if name in words and name not in found and views[name] is not text:
                visit(views[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(name: str) -> str:
    sql, views = ORACLES[name], dict(VIEWS)
    match = re.match(r"__COLLAPSE\((\w+)\)__", sql)
    if match:
        views.update(_collapsed(match.group(1)))
        sql = sql[match.end() :]
    ctes = ", ".join(f"{v} AS ({views[v]})" for v in _needed(sql, views))
    return _with_nulls(f"WITH {ctes} {sql}" if ctes else sql)


def _with_nulls(sql: str) -> str:
    """Printed lists show their NULL items; array_to_string alone would drop them."""
    shown = f"{_LIST}([coalesce(CAST(item AS VARCHAR), '\\N') FOR item IN "
    return sql.replace(f"{_LIST}(", shown).replace(", ',')", "], ',')")
