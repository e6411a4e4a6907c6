"""Independent SQL statement of every registered query, for DuckDB over the same
parquet tables (views region ... conversations are pre-registered by the checker).

The SQL follows the reference's own formulation (left-join chains, MODE() WITHIN
GROUP, ROW_NUMBER keep-first) rather than the DataFrame plans, so agreement is a real
cross-check. Medians use the same interpolation (0.5*lower + 0.5*upper) as Spark, and
double-to-decimal assignment goes through the shortest decimal text of the double, as
Spark does, so half-way cases round identically.
"""

from __future__ import annotations

AS_OF = "2001-08-01"
WS = r"'^\s+|\s+$'"
NUM_RE = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


def num(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({strip(x)}, {NUM_RE}) "
            f"THEN TRY_CAST({strip(x)} AS DOUBLE) END)")


def blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def dec(x: str, p: int, s: int) -> str:
    return f"CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL({p},{s}))"


def int_even(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS INTEGER)"


def bround(x: str, s: int) -> str:
    return f"CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {s}) AS DOUBLE)"


def parse(x: str, fmts: list[str]) -> str:
    return "CAST(COALESCE(" + ", ".join(f"TRY_STRPTIME({x}, '{f}')" for f in fmts) + ") AS DATE)"


USERS_FMTS = ["%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y", "%m/%d/%Y"]
RIDES_FMTS = ["%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y", "%m-%d-%Y"]


def median_sql(src: str, col: str) -> str:
    """Scalar SELECT of Spark's interpolated median of ``col`` over ``src``."""
    return (f"(SELECT CASE WHEN n = 0 THEN NULL WHEN l[(n-1)//2 + 1] = l[n//2 + 1] THEN l[(n-1)//2 + 1] "
            f"ELSE 0.5 * l[(n-1)//2 + 1] + 0.5 * l[n//2 + 1] END "
            f"FROM (SELECT list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL)) AS l, "
            f"count({col}) AS n FROM {src}))")


def _date_txt(k: str, d: str, fourth: str, users: bool) -> str:
    alt = "'31/02/1995'" if users else f"' ' || strftime({d}, '%Y-%m-%d') || ' '"
    return (f"CASE WHEN {k} % 5 = 0 THEN strftime({d}, '%Y-%m-%d') "
            f"WHEN {k} % 5 = 1 THEN strftime({d}, '%d/%m/%Y') "
            f"WHEN {k} % 5 = 2 THEN strftime({d}, '%d.%m.%Y') "
            f"WHEN {k} % 5 = 3 THEN strftime({d}, '{fourth}') "
            f"WHEN {k} % 3 = 0 THEN 'bad' WHEN {k} % 3 = 1 THEN {alt} END")


OFF = "1000000000000"
ORPHAN = "10000000"

BRONZE = f"""
b_users0 AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
         c_name AS name, c_mktsegment AS gender, CAST(18 + c_custkey % 60 AS VARCHAR) AS age,
         {_date_txt('c_custkey', "(DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER))", '%m/%d/%Y', True)} AS signup_date,
         CAST(c_nationkey AS VARCHAR) AS city, c_custkey AS _seq,
         strftime(DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER), '%Y-%m-%d') AS _iso
  FROM customer),
b_users AS (
  SELECT user_id, name, gender, age, signup_date, city, _seq FROM b_users0
  UNION ALL
  SELECT user_id, name || ' (copy)', gender, age, _iso, city, _seq + {OFF} FROM b_users0 WHERE _seq % 53 = 0),
b_captains0 AS (
  SELECT CASE WHEN s_suppkey % 97 = 0 THEN NULL WHEN s_suppkey % 89 = 0 THEN '  ' ELSE CAST(s_suppkey AS VARCHAR) END AS captain_id,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 17 = 0 THEN '   ' ELSE s_name END AS name,
         CASE WHEN s_suppkey % 41 = 0 THEN 'abc' WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(20 + s_suppkey % 40 AS VARCHAR) END AS age,
         CAST(s_suppkey % 30 AS VARCHAR) AS experience_years,
         CASE WHEN s_suppkey % 19 = 0 THEN NULL WHEN s_suppkey % 23 = 0 THEN '  ' || CAST(s_nationkey AS VARCHAR) || ' '
              ELSE CAST(s_nationkey AS VARCHAR) END AS city,
         CASE WHEN s_suppkey % 11 = 0 THEN NULL
              ELSE CAST(CAST(s_suppkey % 51 AS DECIMAL(4,0)) * CAST(0.1 AS DECIMAL(2,1)) AS VARCHAR) END AS rating,
         s_suppkey AS _seq
  FROM supplier),
b_captains AS (
  SELECT * FROM b_captains0
  UNION ALL
  SELECT captain_id, COALESCE(name, '') || ' (copy)', age, experience_years, city, rating, _seq + {OFF}
  FROM b_captains0 WHERE _seq % 53 = 0),
li_sum AS (SELECT l_orderkey, min(l_suppkey) AS _cap, sum(l_linenumber) AS _dur FROM lineitem GROUP BY l_orderkey),
b_rides0 AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '  ' ELSE CAST(o_orderkey AS VARCHAR) END AS ride_id,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN CAST(o_custkey + {ORPHAN} AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 73 = 0 THEN CAST(_cap + {ORPHAN} AS VARCHAR) ELSE CAST(_cap AS VARCHAR) END AS captain_id,
         {_date_txt('o_orderkey', 'CAST(o_orderdate AS DATE)', '%m-%d-%Y', False)} AS ride_date,
         CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE o_orderpriority END AS pickup_loc,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'zone-' || CAST(o_custkey % 25 AS VARCHAR) END AS drop_loc,
         CASE WHEN o_orderkey % 41 = 0 THEN 'abc'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.0001 AS DECIMAL(5,4)) AS VARCHAR) END AS distance_km,
         CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(_dur AS VARCHAR) END AS duration_min,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'completed'
              WHEN o_orderstatus = 'P' THEN 'cancelled' WHEN o_orderstatus = 'O' THEN 'ongoing' END AS ride_status,
         o_orderkey AS _seq, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS _iso
  FROM orders LEFT JOIN li_sum ON o_orderkey = l_orderkey),
b_rides AS (
  SELECT ride_id, user_id, captain_id, ride_date, pickup_loc, drop_loc, distance_km, duration_min, ride_status, _seq FROM b_rides0
  UNION ALL
  SELECT ride_id, user_id, captain_id, _iso, pickup_loc, drop_loc, distance_km, duration_min, 'completed', _seq + {OFF}
  FROM b_rides0 WHERE _seq % 53 = 0),
b_payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
         CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN NULL WHEN (l_orderkey + l_linenumber) % 103 = 0 THEN ' '
              ELSE CAST(l_orderkey AS VARCHAR) END AS ride_id,
         l_returnflag AS payment_method,
         CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN 'abc' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS fare,
         CASE WHEN (l_orderkey + l_linenumber) % 43 = 0 THEN NULL ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS VARCHAR) END AS discount_percent,
         CASE WHEN (l_orderkey + l_linenumber) % 47 = 0 THEN '12d'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR) AS final_amount,
         l_linestatus AS payment_status, l_orderkey * 16 + l_linenumber AS _seq
  FROM lineitem),
b_feedback AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ' ' ELSE CAST(event_id AS VARCHAR) END AS feedback_id,
         CASE WHEN event_id % 79 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS ride_id,
         CASE WHEN event_id % 41 = 0 THEN 'abc' ELSE CAST(event_id % 6 AS VARCHAR) END AS user_rating,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST((event_id + user_id) % 6 AS VARCHAR) END AS captain_rating,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS issue_category,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE props END AS comments,
         event_id AS _seq
  FROM events)"""

SILVER = f"""
l_users0 AS (
  SELECT b.*, {parse('signup_date', USERS_FMTS)} AS _signup FROM b_users b),
l_users1 AS (
  SELECT *, CASE WHEN user_id IS NULL THEN 'null_user_id' WHEN _signup IS NULL THEN 'invalid_signup_date' END AS reason
  FROM l_users0),
l_users AS (
  SELECT *, (reason IS NULL AND ROW_NUMBER() OVER (PARTITION BY user_id, reason IS NULL ORDER BY _seq) > 1) AS _drop
  FROM l_users1),
s_users AS (
  SELECT user_id, name, gender, {int_even(num('age'))} AS age, _signup AS signup_date, city
  FROM l_users WHERE reason IS NULL AND NOT _drop),
a_users AS (SELECT user_id, name, gender, age, signup_date, city, reason FROM l_users WHERE reason IS NOT NULL),
l_captains1 AS (
  SELECT *, CASE WHEN captain_id IS NULL THEN 'null_captain_id' END AS r1 FROM b_captains),
l_captains2 AS (
  SELECT *, COALESCE(r1, CASE WHEN ROW_NUMBER() OVER (PARTITION BY captain_id, r1 IS NULL ORDER BY _seq) > 1
                              THEN 'duplicate_captain_id' END) AS r2,
         {num('age')} AS _age_n, {num('rating')} AS _rating_n
  FROM l_captains1),
cap_alive AS (SELECT * FROM l_captains2 WHERE r2 IS NULL),
l_captains AS (
  SELECT *, CAST(trunc(COALESCE(_age_n, {median_sql('cap_alive', '_age_n')})) AS INTEGER) AS _age,
         {bround(f"COALESCE(_rating_n, {median_sql('cap_alive', '_rating_n')})", 1)} AS _rating,
         COALESCE(r2, CASE WHEN {blank('name')} THEN 'null_or_empty_name' END) AS reason
  FROM l_captains2),
s_captains AS (
  SELECT captain_id, name, _age AS age, CAST(NULL AS INTEGER) AS experience_years,
         {strip("COALESCE(city, 'Unknown')")} AS city, {dec('_rating', 3, 2)} AS rating
  FROM l_captains WHERE reason IS NULL),
a_captains AS (SELECT captain_id, name, age, experience_years, city, rating, reason FROM l_captains WHERE reason IS NOT NULL),
l_rides1 AS (
  SELECT b.*, {parse(strip('ride_date'), RIDES_FMTS)} AS _date FROM b_rides b),
l_rides2 AS (
  SELECT r.*, CASE WHEN {blank('r.ride_id')} THEN 'null_or_empty_ride_id'
                   WHEN {blank('r.user_id')} THEN 'null_or_empty_user_id'
                   WHEN {blank('r.captain_id')} THEN 'null_or_empty_captain_id'
                   WHEN r._date IS NULL THEN 'null_or_invalid_ride_date'
                   WHEN r.user_id NOT IN (SELECT user_id FROM s_users WHERE user_id IS NOT NULL) THEN 'invalid_user_id_not_in_users'
                   WHEN r.captain_id NOT IN (SELECT captain_id FROM s_captains WHERE captain_id IS NOT NULL) THEN 'invalid_captain_id_not_in_captains'
              END AS r1
  FROM l_rides1 r),
l_rides3 AS (
  SELECT *, COALESCE(r1, CASE WHEN ROW_NUMBER() OVER (PARTITION BY ride_id, r1 IS NULL ORDER BY _seq) > 1
                              THEN 'duplicate_ride_id' END) AS reason,
         {num('distance_km')} AS _dist, {num('duration_min')} AS _dur
  FROM l_rides2),
ride_alive AS (SELECT * FROM l_rides3 WHERE reason IS NULL),
s_rides AS (
  SELECT ride_id, user_id, captain_id, _date AS ride_date,
         COALESCE(NULLIF(pickup_loc, ''), 'Unknown') AS pickup_loc, COALESCE(NULLIF(drop_loc, ''), 'Unknown') AS drop_loc,
         {dec(f"COALESCE(_dist, {median_sql('ride_alive', '_dist')})", 7, 2)} AS distance_km,
         {int_even(f"COALESCE(_dur, {median_sql('ride_alive', '_dur')})")} AS duration_min,
         COALESCE(ride_status, (SELECT mode() WITHIN GROUP (ORDER BY ride_status) FROM ride_alive), 'Unknown') AS ride_status
  FROM ride_alive),
a_rides AS (SELECT ride_id, user_id, captain_id, ride_date, pickup_loc, drop_loc, distance_km, duration_min, ride_status, reason
            FROM l_rides3 WHERE reason IS NOT NULL),
l_payments AS (
  SELECT p.*, CASE WHEN {blank('p.ride_id')} THEN 'null_or_empty_ride_id'
                   WHEN p.ride_id NOT IN (SELECT ride_id FROM s_rides WHERE ride_id IS NOT NULL) THEN 'invalid_ride_id_not_in_rides' END AS reason,
         {num('p.fare')} AS _fare
  FROM b_payments p),
pay_alive AS (SELECT * FROM l_payments WHERE reason IS NULL),
s_payments AS (
  SELECT payment_id, ride_id, payment_method,
         {dec(f"COALESCE(_fare, {median_sql('pay_alive', '_fare')})", 10, 2)} AS fare,
         {dec(f"COALESCE({num('discount_percent')}, 0.0)", 5, 2)} AS discount_percent,
         {dec(f"COALESCE({num('discount_amount')}, 0.0)", 10, 2)} AS discount_amount,
         {dec(f"COALESCE({num('final_amount')}, 0.0)", 10, 2)} AS final_amount,
         payment_status
  FROM pay_alive),
a_payments AS (SELECT payment_id, ride_id, payment_method, fare, discount_percent, discount_amount, final_amount,
                      payment_status, reason FROM l_payments WHERE reason IS NOT NULL),
l_feedback AS (
  SELECT f.*, CASE WHEN {blank('f.feedback_id')} THEN 'null_or_empty_feedback_id'
                   WHEN {blank('f.ride_id')} THEN 'null_or_empty_ride_id'
                   WHEN f.ride_id NOT IN (SELECT ride_id FROM s_rides WHERE ride_id IS NOT NULL) THEN 'ride_id_not_in_rides' END AS reason,
         {num('f.user_rating')} AS _ur, {num('f.captain_rating')} AS _cr
  FROM b_feedback f),
fb_alive AS (SELECT * FROM l_feedback WHERE reason IS NULL),
s_feedback AS (
  SELECT feedback_id, ride_id,
         {dec(f"COALESCE(_ur, {median_sql('fb_alive', '_ur')})", 2, 1)} AS user_rating,
         {dec(f"COALESCE(_cr, {median_sql('fb_alive', '_cr')})", 2, 1)} AS captain_rating,
         COALESCE(NULLIF(issue_category, ''), 'No issues') AS issue_category,
         COALESCE(NULLIF(comments, ''), 'No comments') AS comments
  FROM fb_alive),
a_feedback AS (SELECT feedback_id, ride_id, user_rating, captain_rating, issue_category, comments, reason
               FROM l_feedback WHERE reason IS NOT NULL)"""

# One table at ride grain carries what every gold column needs; users and captains are
# grouped from it, and modes are the first of counted values (ties: smallest value).
GOLD = f"""
money AS (SELECT ride_id, sum(final_amount) AS paid FROM s_payments GROUP BY ride_id),
marks AS (
  SELECT ride_id, sum(CAST(nullif(captain_rating, 0) AS DOUBLE)) AS cr_sum, count(nullif(captain_rating, 0)) AS cr_n,
         sum(CAST(nullif(user_rating, 0) AS DOUBLE)) AS ur_sum, count(nullif(user_rating, 0)) AS ur_n,
         sum(CAST(user_rating AS DOUBLE)) AS any_sum, count(user_rating) AS any_n
  FROM s_feedback GROUP BY ride_id),
ride_issue AS (
  SELECT ride_id, issue_category AS top_issue FROM s_feedback WHERE issue_category IS NOT NULL
  GROUP BY ride_id, issue_category
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY count(*) DESC, issue_category) = 1),
facts AS (
  SELECT r.ride_id, r.user_id, r.captain_id, r.ride_date, r.distance_km, r.duration_min,
         coalesce(r.ride_status = 'completed', false) AS done, coalesce(r.ride_status = 'cancelled', false) AS called_off,
         coalesce(r.ride_date >= DATE '{AS_OF}' - INTERVAL 30 DAY, false) AS recent,
         coalesce(money.paid, 0) AS paid, marks.* EXCLUDE (ride_id), cr_sum / nullif(cr_n, 0) AS cr_mean, top_issue
  FROM s_rides r LEFT JOIN money USING (ride_id) LEFT JOIN marks USING (ride_id) LEFT JOIN ride_issue USING (ride_id)),
g_users AS (
  SELECT u.user_id, u.name, u.age, u.gender, u.city, u.signup_date, t.first_ride_date, t.last_ride_date,
         coalesce(t.n, 0) AS total_rides, coalesce(t.revenue, 0) AS total_revenue,
         CAST(t.revenue AS DOUBLE) / t.n AS avg_revenue_per_ride, coalesce(t.recent_n, 0) AS booking_frequency,
         CAST(coalesce(t.seen, false) AS INTEGER) AS is_active, t.rating AS avg_captain_rating,
         i.top_issue AS most_frequent_issue
  FROM s_users u
  LEFT JOIN (SELECT user_id, count(*) AS n, min(ride_date) AS first_ride_date, max(ride_date) AS last_ride_date,
                    sum(paid) AS revenue, count_if(recent) AS recent_n, bool_or(done OR called_off) AS seen,
                    avg(cr_mean) AS rating
             FROM facts GROUP BY user_id) t USING (user_id)
  LEFT JOIN (SELECT user_id, top_issue FROM facts WHERE top_issue IS NOT NULL GROUP BY user_id, top_issue
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, top_issue) = 1) i USING (user_id)),
captain_words AS (
  SELECT captain_id, kind, word FROM (
    SELECT captain_id, unnest(['issue', 'comment']) AS kind, unnest([issue_category, comments]) AS word
    FROM s_feedback JOIN s_rides USING (ride_id))
  WHERE word IS NOT NULL GROUP BY captain_id, kind, word
  QUALIFY row_number() OVER (PARTITION BY captain_id, kind ORDER BY count(*) DESC, word) = 1),
g_captains AS (
  SELECT c.captain_id, c.name, c.age, c.city, c.rating AS average_rating, coalesce(t.n, 0) AS total_rides,
         coalesce(t.done_n, 0) AS completed_rides, coalesce(t.off_n, 0) AS cancelled_rides,
         coalesce(t.km, 0) AS total_distance_km, coalesce(t.minutes, 0) AS total_duration_min,
         coalesce(t.paid, 0) AS total_final_amount, t.cr AS avg_captain_rating, t.ur AS avg_user_rating,
         if(coalesce(t.done_n + t.off_n, 0) > 0, 'active', 'inactive') AS status,
         (SELECT word FROM captain_words w WHERE w.captain_id = c.captain_id AND kind = 'issue') AS most_frequent_issue,
         (SELECT word FROM captain_words w WHERE w.captain_id = c.captain_id AND kind = 'comment') AS most_frequent_comment
  FROM s_captains c
  LEFT JOIN (SELECT captain_id, count(*) AS n, count_if(done) AS done_n, count_if(called_off) AS off_n,
                    sum(distance_km) AS km, sum(duration_min) AS minutes, sum(paid) AS paid,
                    sum(cr_sum) / nullif(sum(cr_n), 0) AS cr, sum(ur_sum) / nullif(sum(ur_n), 0) AS ur
             FROM facts GROUP BY captain_id) t USING (captain_id))"""

# Each side is one row of numbers, laid out as (metric, value) lists.
_USER_METRICS = ("['total_rides', 'total_revenue', 'avg_revenue_per_ride', 'booking_frequency', 'is_active',"
                 " 'avg_captain_rating', 'most_frequent_issue']")
_CAPTAIN_METRICS = ("['total_captains', 'total_rides_sum', 'completed_rides_sum', 'cancelled_rides_sum',"
                    " 'total_distance_km_sum', 'total_duration_min_sum', 'total_final_amount_sum',"
                    " 'avg_user_rating_avg']")


def _metric_rows(names: str, values: list[str], text: str | None, source: str) -> str:
    numbers = ", ".join(f"CAST({v} AS DOUBLE)" for v in values)
    if text is None:
        return f"SELECT unnest({names}) AS metric, unnest([{numbers}]) AS value FROM {source}"
    blanks = ", ".join("CAST(NULL AS VARCHAR)" for _ in values[:-1])
    return (f"SELECT unnest({names}) AS metric, unnest([{numbers}]) AS value,"
            f" unnest([{blanks}, {text}]) AS text FROM {source}")


_COMMON_ISSUE = "(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"

RECON = f"""
known_feedback AS (SELECT * FROM s_feedback SEMI JOIN s_rides USING (ride_id)),
rec_user_silver AS ({_metric_rows(_USER_METRICS, [
    "count(*)", "sum(paid)",
    "(SELECT avg(CAST(nullif(final_amount, 0) AS DOUBLE)) FROM s_payments SEMI JOIN s_rides USING (ride_id))",
    "count_if(recent)", "count(DISTINCT user_id) FILTER (WHERE done OR called_off)",
    "(SELECT avg(CAST(nullif(captain_rating, 0) AS DOUBLE)) FROM known_feedback)", "NULL"],
    _COMMON_ISSUE.format(c="issue_category", t="known_feedback"), "facts")}),
rec_user_gold AS ({_metric_rows(_USER_METRICS, [
    "sum(total_rides)", "sum(total_revenue)", "sum(avg_revenue_per_ride * total_rides) / nullif(sum(total_rides), 0)",
    "sum(booking_frequency)", "sum(is_active)", "avg(avg_captain_rating)", "NULL"],
    _COMMON_ISSUE.format(c="most_frequent_issue", t="g_users"), "g_users")}),
rec_cap_silver AS ({_metric_rows(_CAPTAIN_METRICS, [
    "(SELECT count(DISTINCT captain_id) FROM s_captains)", "coalesce(sum(n), 0)", "coalesce(sum(done_n), 0)",
    "coalesce(sum(off_n), 0)", "coalesce(sum(km), 0)", "coalesce(sum(minutes), 0)", "coalesce(sum(paid), 0)",
    "coalesce(avg(ur), 0)"], None,
    "(SELECT count(*) AS n, count_if(done) AS done_n, count_if(called_off) AS off_n, sum(distance_km) AS km,"
    " sum(duration_min) AS minutes, sum(paid) AS paid, sum(any_sum) / nullif(sum(any_n), 0) AS ur"
    " FROM facts SEMI JOIN s_captains USING (captain_id) GROUP BY captain_id)")}),
rec_cap_gold AS ({_metric_rows(_CAPTAIN_METRICS, [
    "count(DISTINCT captain_id)", *(f"coalesce(sum({c}), 0)" for c in (
        "total_rides", "completed_rides", "cancelled_rides", "total_distance_km", "total_duration_min",
        "total_final_amount")), "coalesce(avg(avg_user_rating), 0)"], None, "g_captains")})"""


def compare_sql(silver: str, gold: str, entity: str, text: bool) -> str:
    st = "s.text" if text else "CAST(NULL AS VARCHAR)"
    gt = "g.text" if text else "CAST(NULL AS VARCHAR)"
    return f"""
  SELECT COALESCE(s.metric, g.metric) AS metric, s.value AS silver_value, g.value AS gold_value,
         {st} AS silver_text, {gt} AS gold_text,
         CASE WHEN s.value IS NOT NULL AND g.value IS NOT NULL THEN s.value - g.value END AS difference,
         CASE WHEN s.value IS NOT NULL AND g.value IS NOT NULL
              THEN CASE WHEN abs(s.value - g.value) < 0.01 THEN 'OK' ELSE 'MISMATCH' END
              WHEN s.value IS NOT DISTINCT FROM g.value AND {st} IS NOT DISTINCT FROM {gt} THEN 'OK'
              ELSE 'MISMATCH' END AS status,
         '{entity}' AS entity
  FROM {silver} s FULL OUTER JOIN {gold} g ON s.metric = g.metric"""


PREFIX = "WITH " + BRONZE.strip() + ",\n" + SILVER.strip() + ",\n" + GOLD.strip() + ",\n" + RECON.strip() + "\n"


def _q(body: str) -> str:
    return PREFIX + body


def _r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def _d(expr: str, alias: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {alias}"


USER_AGG_SELECT = f"""SELECT user_id, name, CAST(age AS BIGINT) AS age, gender, city, {_d('signup_date', 'signup_date')},
  {_d('first_ride_date', 'first_ride_date')}, {_d('last_ride_date', 'last_ride_date')}, total_rides,
  CAST(total_revenue AS DOUBLE) AS total_revenue, {_r6('avg_revenue_per_ride', 'avg_revenue_per_ride')},
  booking_frequency, CAST(is_active AS BIGINT) AS is_active, {_r6('avg_captain_rating', 'avg_captain_rating')},
  most_frequent_issue FROM g_users"""

CAPTAIN_AGG_SELECT = f"""SELECT captain_id, name, CAST(age AS BIGINT) AS age, city, CAST(average_rating AS DOUBLE) AS average_rating,
  total_rides, completed_rides, cancelled_rides, CAST(total_distance_km AS DOUBLE) AS total_distance_km,
  CAST(total_duration_min AS BIGINT) AS total_duration_min, CAST(total_final_amount AS DOUBLE) AS total_final_amount,
  {_r6('avg_captain_rating', 'avg_captain_rating')}, {_r6('avg_user_rating', 'avg_user_rating')}, status,
  most_frequent_issue, most_frequent_comment FROM g_captains"""

REPORT_COLS = ("metric, round(silver_value, 6) AS silver_value, round(gold_value, 6) AS gold_value, silver_text, "
               "gold_text, round(difference, 6) AS difference, status, entity")

SQL: dict[str, str] = {
    "captain_aggregate": _q(CAPTAIN_AGG_SELECT),
    "user_aggregate": _q(USER_AGG_SELECT),
    "dashboard_data": _q(f"""
, details AS (
  SELECT coalesce(p.ride_id, f.ride_id) AS ride_id, p.* EXCLUDE (ride_id),
         f.* EXCLUDE (ride_id, captain_rating), f.captain_rating AS feedback_captain_rating
  FROM (SELECT ride_id, payment_id, payment_method, fare, discount_percent, discount_amount, final_amount, payment_status
        FROM s_payments) p
  FULL JOIN (SELECT ride_id, feedback_id, user_rating, captain_rating, issue_category, comments FROM s_feedback) f
    ON p.ride_id = f.ride_id),
known AS (SELECT r.* FROM s_rides r SEMI JOIN s_users USING (user_id)),
trips AS (SELECT known.*, details.* EXCLUDE (ride_id) FROM known LEFT JOIN details USING (ride_id)),
everyone AS (
  SELECT u.user_id, u.name AS user_name, u.gender, u.age AS user_age, u.signup_date, u.city AS user_city,
         t.* EXCLUDE (user_id, captain_id), t.captain_id
  FROM s_users u LEFT JOIN trips t USING (user_id)
  UNION ALL BY NAME
  SELECT captain_id FROM s_captains ANTI JOIN known USING (captain_id))
SELECT e.user_id, user_name, gender, CAST(user_age AS BIGINT) AS user_age, {_d('signup_date', 'signup_date')}, user_city, ride_id,
       e.captain_id, {_d('ride_date', 'ride_date')}, pickup_loc, drop_loc,
       CAST(distance_km AS DOUBLE) AS distance_km, CAST(duration_min AS BIGINT) AS duration_min, ride_status, payment_id,
       payment_method, CAST(fare AS DOUBLE) AS fare, CAST(discount_percent AS DOUBLE) AS discount_percent,
       CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(final_amount AS DOUBLE) AS final_amount, payment_status,
       feedback_id, CAST(user_rating AS DOUBLE) AS user_rating,
       CAST(feedback_captain_rating AS DOUBLE) AS feedback_captain_rating, issue_category, comments,
       c.name AS captain_name, CAST(c.age AS BIGINT) AS captain_age, c.city AS captain_city,
       CAST(c.rating AS DOUBLE) AS captain_overall_rating
FROM everyone e LEFT JOIN s_captains c USING (captain_id)"""),
    "dashboard_fanout": _q("""
, left_side AS (
  SELECT r.captain_id, COUNT(*) AS left_rows
  FROM s_users u JOIN s_rides r ON u.user_id = r.user_id
  LEFT JOIN s_payments p ON r.ride_id = p.ride_id LEFT JOIN s_feedback f ON r.ride_id = f.ride_id
  GROUP BY r.captain_id),
captain_side AS (
  SELECT c.captain_id, COUNT(*) AS captain_rows FROM s_captains c LEFT JOIN s_rides r ON c.captain_id = r.captain_id
  GROUP BY c.captain_id)
SELECT cs.captain_id, COALESCE(ls.left_rows, 0) AS left_rows, cs.captain_rows,
       CASE WHEN ls.left_rows > 0 THEN ls.left_rows * cs.captain_rows ELSE cs.captain_rows END AS fanout_rows
FROM captain_side cs LEFT JOIN left_side ls ON cs.captain_id = ls.captain_id"""),
    "reconcile_users": _q(f"SELECT {REPORT_COLS} FROM (" + compare_sql("rec_user_silver", "rec_user_gold", "User", True) + ")"),
    "reconcile_captains": _q(f"SELECT {REPORT_COLS} FROM (" + compare_sql("rec_cap_silver", "rec_cap_gold", "Captain", False) + ")"),
    "reconcile_report": _q(f"SELECT {REPORT_COLS} FROM (" + compare_sql("rec_user_silver", "rec_user_gold", "User", True)
                           + " UNION ALL " + compare_sql("rec_cap_silver", "rec_cap_gold", "Captain", False) + ")"),
    "clean_users": _q(f"SELECT user_id, name, gender, CAST(age AS BIGINT) AS age, {_d('signup_date', 'signup_date')}, city FROM s_users"),
    "clean_captains": _q("SELECT captain_id, name, CAST(age AS BIGINT) AS age, CAST(experience_years AS BIGINT) AS experience_years, "
                         "city, CAST(rating AS DOUBLE) AS rating FROM s_captains"),
    "clean_rides": _q(f"SELECT ride_id, user_id, captain_id, {_d('ride_date', 'ride_date')}, pickup_loc, drop_loc, "
                      "CAST(distance_km AS DOUBLE) AS distance_km, CAST(duration_min AS BIGINT) AS duration_min, ride_status FROM s_rides"),
    "clean_payments": _q("SELECT payment_id, ride_id, payment_method, CAST(fare AS DOUBLE) AS fare, CAST(discount_percent AS DOUBLE) AS discount_percent, "
                         "CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(final_amount AS DOUBLE) AS final_amount, payment_status FROM s_payments"),
    "clean_feedback": _q("SELECT feedback_id, ride_id, CAST(user_rating AS DOUBLE) AS user_rating, CAST(captain_rating AS DOUBLE) AS captain_rating, "
                         "issue_category, comments FROM s_feedback"),
    "audit_users": _q("SELECT * FROM a_users"),
    "audit_captains": _q("SELECT * FROM a_captains"),
    "audit_rides": _q("SELECT * FROM a_rides"),
    "audit_payments": _q("SELECT * FROM a_payments"),
    "audit_feedback": _q("SELECT * FROM a_feedback"),
    "rejects_by_reason": _q(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, reason, COUNT(*) AS n FROM a_{t} GROUP BY reason"
        for t in ["users", "captains", "rides", "payments", "feedback"])),
    "reject_null_keys": _q(f"""SELECT captain_id, name, _seq,
        CASE WHEN captain_id IS NULL THEN 'null_captain_id' WHEN {blank('name')} THEN 'null_or_empty_name' END AS reason
        FROM b_captains"""),
    "reject_blank_keys": _q(f"""SELECT ride_id, user_id, captain_id, _seq,
        CASE WHEN {blank('ride_id')} THEN 'null_or_empty_ride_id' WHEN {blank('user_id')} THEN 'null_or_empty_user_id'
             WHEN {blank('captain_id')} THEN 'null_or_empty_captain_id' END AS reason FROM b_rides"""),
    "parse_dates_users": _q(f"SELECT _seq, signup_date, {_d(parse('signup_date', USERS_FMTS), 'parsed')} FROM b_users"),
    "parse_dates_rides": _q(f"SELECT _seq, ride_date, {_d(parse(strip('ride_date'), RIDES_FMTS), 'parsed')} FROM b_rides"),
    "reject_bad_dates": _q(f"""SELECT 'users' AS table_name, _seq, signup_date AS raw_date, 'invalid_signup_date' AS reason
        FROM b_users WHERE {parse('signup_date', USERS_FMTS)} IS NULL
        UNION ALL SELECT 'rides', _seq, ride_date, 'null_or_invalid_ride_date'
        FROM b_rides WHERE {parse(strip('ride_date'), RIDES_FMTS)} IS NULL"""),
    "orphans": _q("""SELECT ride_id, user_id, captain_id, _seq, CASE
          WHEN user_id IS NULL OR user_id NOT IN (SELECT user_id FROM s_users WHERE user_id IS NOT NULL) THEN 'invalid_user_id_not_in_users'
          ELSE 'invalid_captain_id_not_in_captains' END AS reason
        FROM b_rides WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM s_users WHERE user_id IS NOT NULL)
          OR captain_id IS NULL OR captain_id NOT IN (SELECT captain_id FROM s_captains WHERE captain_id IS NOT NULL)"""),
    "referential_keep": _q("SELECT payment_id, ride_id, fare FROM b_payments WHERE ride_id IN (SELECT ride_id FROM s_rides)"),
    "dedupe_keep_first": _q("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn FROM lineitem) WHERE rn = 1"""),
    "dedupe_rejects": _q("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice,
        'duplicate_line' AS reason FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn FROM lineitem) WHERE rn > 1"""),
    "coerce_numeric": _q(f"SELECT payment_id, discount_amount, round({num('discount_amount')}, 6) AS value, fare, "
                         f"round({num('fare')}, 6) AS fare_value FROM b_payments"),
    "impute_median": _q(f", med_src AS (SELECT {num('user_rating')} AS _v FROM b_feedback) "
                        f"SELECT _seq, user_rating, round(COALESCE({num('user_rating')}, {median_sql('med_src', '_v')}), 6) AS value FROM b_feedback"),
    "impute_mode": _q("SELECT _seq, ride_status, COALESCE(ride_status, (SELECT mode() WITHIN GROUP (ORDER BY ride_status) FROM b_rides), 'Unknown') AS value FROM b_rides"),
    "impute_const": _q(f"""SELECT CAST(_seq AS VARCHAR) AS row_id, COALESCE(NULLIF(issue_category, ''), 'No issues') AS text_a,
          COALESCE(NULLIF(comments, ''), 'No comments') AS text_b, CAST(NULL AS DOUBLE) AS number FROM b_feedback
        UNION ALL SELECT payment_id, NULL, NULL, round(COALESCE({num('discount_percent')}, 0.0), 6) FROM b_payments"""),
    "round_truncate": _q(f"SELECT _seq, CAST(trunc({num('age')} / 3) AS BIGINT) AS age_third, "
                         f"round({bround(num('rating') + ' / 2', 1)}, 6) AS half_rating_1dp, round({bround(num('rating'), 1)}, 6) AS rating_1dp FROM b_captains"),
    "trim_text": _q("SELECT _seq, city, " + strip("COALESCE(city, 'Unknown')") + " AS clean_city FROM b_captains"),
    "conform_types": _q("SELECT ride_id, CAST(CAST(TRY_CAST(distance_km AS DOUBLE) AS DECIMAL(7,2)) AS DOUBLE) AS distance_km, "
                        "CAST(round_even(TRY_CAST(duration_min AS DOUBLE), 0) AS BIGINT) AS duration_min FROM b_rides"),
    "left_join_rides": _q(f"SELECT u.user_id, u.name, r.ride_id, {_d('r.ride_date', 'ride_date')} FROM s_users u LEFT JOIN s_rides r ON u.user_id = r.user_id"),
    "inner_join_payments": _q("SELECT p.ride_id, p.payment_id, CAST(p.final_amount AS DOUBLE) AS final_amount, r.ride_status "
                              "FROM s_payments p JOIN s_rides r ON p.ride_id = r.ride_id"),
    "full_outer_captains": _q("SELECT r.ride_id, r.captain_id, c.captain_id AS cap_id, c.name AS captain_name "
                              "FROM s_rides r FULL OUTER JOIN s_captains c ON r.captain_id = c.captain_id"),
    "semi_join": _q("SELECT ride_id, captain_id FROM s_rides WHERE ride_id IN (SELECT ride_id FROM s_feedback)"),
    "anti_join": _q("SELECT ride_id, user_id FROM s_rides r WHERE NOT EXISTS (SELECT 1 FROM s_payments p WHERE p.ride_id = r.ride_id)"),
    "count_filter": _q("SELECT captain_id, COUNT(*) FILTER (WHERE ride_status = 'completed') AS completed_rides, "
                       "COUNT(*) FILTER (WHERE ride_status = 'cancelled') AS cancelled_rides, COUNT(*) AS all_rides FROM s_rides GROUP BY captain_id"),
    "count_distinct": _q("SELECT ride_status, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT captain_id) AS captains FROM s_rides GROUP BY ride_status"),
    "sum_coalesce": _q("""SELECT r.user_id, CAST(COALESCE(SUM(rp.total_payment), 0) AS DOUBLE) AS revenue,
          CAST(SUM(COALESCE(rp.total_payment, 0)) AS DOUBLE) AS revenue_zero_filled
        FROM s_rides r LEFT JOIN (SELECT ride_id, SUM(COALESCE(final_amount, 0)) AS total_payment FROM s_payments GROUP BY ride_id) rp
        ON r.ride_id = rp.ride_id GROUP BY r.user_id"""),
    "avg_nullif": _q(f"""SELECT r.captain_id, {_r6('AVG(CAST(NULLIF(f.captain_rating, 0) AS DOUBLE))', 'avg_captain_rating')},
          {_r6('AVG(CAST(NULLIF(f.user_rating, 0) AS DOUBLE))', 'avg_user_rating')}
        FROM s_feedback f JOIN s_rides r ON f.ride_id = r.ride_id GROUP BY r.captain_id"""),
    "min_max_dates": _q(f"SELECT user_id, {_d('min(ride_date)', 'first_ride_date')}, {_d('max(ride_date)', 'last_ride_date')} FROM s_rides GROUP BY user_id"),
    "mode_within_group": _q("""SELECT r.captain_id, MODE() WITHIN GROUP (ORDER BY f.issue_category) AS most_frequent_issue
        FROM s_feedback f JOIN s_rides r ON f.ride_id = r.ride_id GROUP BY r.captain_id"""),
    "weighted_avg": _q(f"SELECT gender, {_r6('SUM(avg_revenue_per_ride * total_rides) / NULLIF(SUM(total_rides), 0)', 'avg_revenue_per_ride')} "
                       "FROM g_users GROUP BY gender"),
    "two_level_agg": _q(f"""SELECT r.captain_id, {_r6('AVG(pr.ride_avg)', 'avg_of_ride_avgs')}, COUNT(pr.ride_avg) AS rated_rides
        FROM s_rides r LEFT JOIN (SELECT ride_id, AVG(CAST(NULLIF(captain_rating, 0) AS DOUBLE)) AS ride_avg FROM s_feedback GROUP BY ride_id) pr
        ON r.ride_id = pr.ride_id GROUP BY r.captain_id"""),
    "guarded_ratio": _q(f"SELECT user_id, total_rides, {_r6('avg_revenue_per_ride', 'avg_revenue_per_ride')} FROM g_users"),
    "active_flag": _q("SELECT 'user' AS entity, user_id, CAST(is_active AS VARCHAR) AS flag FROM g_users "
                      "UNION ALL SELECT 'captain', captain_id, status FROM g_captains"),
    "recent_30_days": _q(f"SELECT user_id, COUNT(*) AS booking_frequency FROM s_rides WHERE ride_date >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY user_id"),
    "median_global": _q(f", mr AS (SELECT {num('distance_km')} AS v FROM b_rides), mp AS (SELECT {num('fare')} AS v FROM b_payments) "
                        f"SELECT 'distance_km' AS column_name, round({median_sql('mr', 'v')}, 6) AS median_value "
                        f"UNION ALL SELECT 'fare', round({median_sql('mp', 'v')}, 6)"),
    "mode_global": _q("SELECT 'ride_status' AS column_name, (SELECT mode() WITHIN GROUP (ORDER BY ride_status) FROM b_rides) AS mode_value "
                      "UNION ALL SELECT 'issue_category', (SELECT mode() WITHIN GROUP (ORDER BY issue_category) FROM s_feedback)"),
    "union_by_name": _q("SELECT user_id, name, gender, age, signup_date, city, NULL AS captain_id, NULL AS experience_years, "
                        "NULL AS rating, reason FROM a_users UNION ALL SELECT NULL, name, NULL, age, NULL, city, captain_id, "
                        "experience_years, rating, reason FROM a_captains"),
    "sort_nulls_last": _q("SELECT captain_id, most_frequent_issue, total_rides FROM g_captains "
                          "ORDER BY most_frequent_issue NULLS LAST, captain_id NULLS LAST"),
    "bronze_roundtrip": _q("SELECT NULLIF(ride_id, '') AS ride_id, NULLIF(user_id, '') AS user_id, NULLIF(captain_id, '') AS captain_id, "
                           "NULLIF(ride_date, '') AS ride_date, NULLIF(pickup_loc, '') AS pickup_loc, NULLIF(drop_loc, '') AS drop_loc, "
                           "NULLIF(distance_km, '') AS distance_km, NULLIF(duration_min, '') AS duration_min, "
                           "NULLIF(ride_status, '') AS ride_status FROM b_rides"),
    "export_snapshot": _q(CAPTAIN_AGG_SELECT),
    "full_refresh": _q(CAPTAIN_AGG_SELECT),
}


def _violation_sql(table: str, chk) -> str:
    t, c = f"s_{table}", chk.column
    head = f"SELECT '{table}' AS table_name, '{chk.name}' AS check_name, '{c}' AS column_name, "
    if chk.kind == "not_null":
        return head + f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {t}"
    if chk.kind == "range":
        conds = []
        if chk.low is not None:
            conds.append(f"{c} {'<' if chk.low_inclusive else '<='} {chk.low}")
        if chk.high is not None:
            conds.append(f"{c} > {chk.high}")
        return head + f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND ({' OR '.join(conds)})) AS violations FROM {t}"
    if chk.kind == "max_len":
        return head + f"COUNT(*) FILTER (WHERE length({c}) > {chk.max_len}) AS violations FROM {t}"
    if chk.kind == "unique":
        return head + (f"COALESCE(SUM(n), 0) AS violations FROM (SELECT {c}, COUNT(*) AS n FROM {t} "
                       f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
    if chk.kind == "foreign_key":
        return head + (f"COUNT(*) AS violations FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM s_{chk.ref_table} r WHERE r.{chk.ref_column} = x.{c})")
    raise ValueError(chk.kind)


def _violations_all() -> str:
    from kiln.schemas import TABLES
    parts = [_violation_sql(n, chk) for n, spec in TABLES.items() for chk in spec.checks]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


SQL["expectation_violations"] = _q(_violations_all())


# Constraint quarantine: one verdict list per table, parents first. A parent key that is gone
# carries its depth; of live rows that share a key the least by all columns stays.
def _local_case(chk) -> str:
    c = chk.column
    if chk.kind == "not_null":
        return f"{c} IS NULL"
    if chk.kind == "max_len":
        return f"length({c}) > {chk.max_len}"
    ends = ([f"{c} {'<' if chk.low_inclusive else '<='} {chk.low}"] if chk.low is not None else [])
    return " OR ".join(ends + ([f"{c} > {chk.high}"] if chk.high is not None else []))


def _quarantine_ctes(tables: dict, checks: dict) -> str:
    ctes = []
    for name, spec in tables.items():
        local = [c for c in checks[name] if c.kind in ("not_null", "range", "max_len")]
        keys = [c for c in checks[name] if c.kind == "foreign_key"]
        unique = [c for c in checks[name] if c.kind == "unique"]
        verdicts = [f"CASE WHEN {_local_case(c)} THEN {{'r': 'constraint {c.name} on {c.column}', 'd': 0}} END"
                    for c in local]
        verdicts += [f"CASE WHEN t.{c.column} IS NOT NULL AND (p{i}.k IS NULL OR p{i}.gone IS NOT NULL) THEN "
                     f"{{'r': 'constraint {c.name} on {c.column}', 'd': coalesce(p{i}.gone + 1, 0)}} END"
                     for i, c in enumerate(keys)]
        joins = " ".join(f"LEFT JOIN (SELECT {c.ref_column} AS k, CASE WHEN NOT bool_or(v IS NULL) THEN min(v.d) END AS gone "
                         f"FROM v_{c.ref_table} GROUP BY 1) p{i} ON p{i}.k = t.{c.column}" for i, c in enumerate(keys))
        ctes.append(f"v0_{name} AS MATERIALIZED (SELECT t.*, coalesce({', '.join(verdicts)}) AS v FROM s_{name} t {joins})")
        columns = ", ".join(f"{c} NULLS FIRST" for c, _ in spec.silver_types)
        later = " ".join(
            f"WHEN v IS NULL AND {c.column} IS NOT NULL AND row_number() OVER (PARTITION BY {c.column}, v IS NULL ORDER BY {columns}) > 1 "
            f"THEN {{'r': 'constraint {c.name} on {c.column}', 'd': 0}}" for c in unique)
        ctes.append(f"v_{name} AS MATERIALIZED (SELECT * REPLACE (CASE {later} ELSE v END AS v) FROM v0_{name})")
    return ", " + ",\n".join(ctes) + "\n"


def _quarantine_sql() -> dict[str, str]:
    from kiln.plans.catalog import STRICT_CHECKS
    from kiln.schemas import TABLES
    ctes = _quarantine_ctes(TABLES, {n: [*STRICT_CHECKS[n], *t.checks] for n, t in TABLES.items()})
    return {"quarantine_violations": _q(ctes + " UNION ALL ".join(
                f"SELECT '{n}' AS table_name, {t.key} AS row_key, v.r AS reason, v.d AS depth FROM v_{n} WHERE v IS NOT NULL"
                for n, t in TABLES.items())),
            "quarantine_kept": _q(ctes + " UNION ALL ".join(
                f"SELECT '{n}' AS table_name, count(*) AS kept_rows, count(DISTINCT {t.key}) AS kept_keys, 0 AS violations "
                f"FROM v_{n} WHERE v IS NULL" for n, t in TABLES.items()))}


SQL.update(_quarantine_sql())


def _cell_sql(table: str, source: str, key: str, column: str, kind: str, fits: str, raw: str | None = None) -> str:
    raw = raw or column
    is_number = f"regexp_full_match({strip(raw)}, {NUM_RE})"
    return (f"SELECT '{table}' AS table_name, {key} AS row_key, '{column}' AS column_name, {raw} AS raw_text, "
            f"'{kind}' AS target_type, CASE WHEN {is_number} THEN 'overflow' ELSE 'malformed' END AS problem "
            f"FROM {source} WHERE NOT {blank(raw)} AND NOT coalesce({is_number} AND {fits.format(num(raw))}, false)")


def _cast_rejects_sql() -> str:
    from kiln.schemas import TABLES
    age = ("(CASE WHEN _seq % 61 = 0 THEN '99999999999' WHEN _seq % 59 = 0 THEN ' abc' "
           "WHEN _seq % 67 = 0 THEN '1e999' WHEN _seq % 71 = 0 THEN ' ' ELSE age END)")
    sources = {"users": "(SELECT * FROM l_users WHERE reason IS NULL AND NOT _drop)",
               "captains": "(SELECT * FROM l_captains WHERE reason IS NULL)", "rides": "ride_alive",
               "payments": "pay_alive", "feedback": "fb_alive"}
    parts = []
    for name, spec in TABLES.items():
        for column, typ in spec.silver_types:
            kind = typ.simpleString()
            if kind == "int" and column != "experience_years":
                parts.append(_cell_sql(name, sources[name], spec.key, column, kind,
                                       "abs(round_even({}, 0)) <= 2147483647", age if name == "users" else None))
            elif kind.startswith("decimal"):
                parts.append(_cell_sql(name, sources[name], spec.key, column, kind,
                                       f"TRY_CAST({{}} AS {kind.upper()}) IS NOT NULL"))
    return _q(" UNION ALL ".join(parts))


SQL["cast_rejects"] = _cast_rejects_sql()


def _sources_sql() -> dict[str, str]:
    from kiln.schemas import TABLES
    cells = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, concat_ws('|', " + ", ".join(
            f"coalesce(NULLIF({c}, ''), '<null>')" for c in t.bronze_columns) + f") AS cells FROM b_{n}"
        for n, t in TABLES.items())
    users = TABLES["users"].bronze_columns
    whole = ", ".join(f"coalesce({c}, '')" for c in users)
    short = ", ".join(f"coalesce({c}, '')" for c in users[:4])
    counts = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{n}' AS table_name, count(*) AS written_rows, count(*) AS scanned_rows FROM {p}_{n}"
        for layer, p in (("silver", "s"), ("audit", "a")) for n in TABLES)
    stamps = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{AS_OF} 00:00:00' AS run_ts, count(*) AS rejected FROM a_{n} HAVING count(*) > 0"
        for n in TABLES)
    return {
        "csv_null_tokens": _q(cells), "load_counts": _q(counts), "run_stamp": _q(stamps),
        "csv_line_audit": _q(f"""SELECT 'surplus_cells' AS problem, concat_ws(',', {whole}, 'EXTRA') AS raw_line, false AS loaded, 1 AS rows
            FROM b_users WHERE _seq % 60 = 7
            UNION ALL SELECT 'short_line', concat_ws(',', {short}), true, 1 FROM b_users WHERE _seq % 60 = 9
            UNION ALL SELECT 'loaded', NULL, true, count(*) FROM b_users WHERE _seq % 60 <> 7"""),
        "reconcile_observed": SQL["reconcile_report"], "dashboard_bucketed": SQL["dashboard_data"],
        "report_csv": f"""WITH r AS ({SQL['reconcile_report']}), o AS (
            SELECT unnest({_USER_METRICS} || {_CAPTAIN_METRICS}) AS metric, unnest(range(1, 16)) AS line)
            SELECT line, metric AS "Metric", silver_value AS "Silver", gold_value AS "Gold", status AS "Status",
                   entity AS "Entity" FROM r JOIN o USING (metric)""",
        "dedupe_incremental": SQL["dedupe_keep_first"].replace(
            "SELECT *, ROW_NUMBER()", "SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies, ROW_NUMBER()")
            .replace("AS l_extendedprice FROM", "AS l_extendedprice, copies FROM"),
        "reconcile_drilldown": _q(""", gold AS (
            SELECT captain_id, coalesce(TRY_CAST(captain_id AS BIGINT), -1) AS k, total_rides, total_distance_km, total_final_amount,
                   if(k % 19 <> 0, 1, 0) + if(k % 23 = 0, 1, 0) AS times FROM g_captains
          ), faulty AS (
            SELECT captain_id, times, times * total_rides AS total_rides, times * total_distance_km AS total_distance_km,
                   times * (total_final_amount + CASE k % 17 WHEN 0 THEN 5 WHEN 1 THEN -5 ELSE 0 END) AS total_final_amount
            FROM gold WHERE times > 0
          ), both_sides AS (
            SELECT g.captain_id, g.times = 0 AS missing,
                   unnest(['rows', 'total_rides', 'total_distance_km', 'total_final_amount']) AS measure,
                   unnest([CAST(1 AS DECIMAL(18,2)), CAST(g.total_rides AS DECIMAL(18,2)), g.total_distance_km, g.total_final_amount]) AS left_value,
                   unnest([CAST(f.times AS DECIMAL(18,2)), CAST(f.total_rides AS DECIMAL(18,2)), f.total_distance_km, f.total_final_amount]) AS right_value
            FROM gold g LEFT JOIN faulty f USING (captain_id))
          SELECT captain_id AS row_key, measure, CAST(left_value AS DOUBLE) AS left_value, CAST(right_value AS DOUBLE) AS right_value,
                 round(CAST(left_value - right_value AS DOUBLE), 6) AS difference
          FROM both_sides WHERE missing OR left_value IS DISTINCT FROM right_value"""),
        "dashboard_fanout_page": _q(_fanout_sql()),
    }


def _fanout_sql() -> str:
    from kiln.plans.gold import DASHBOARD_COLUMNS
    dates = {"signup_date", "ride_date"}
    numbers = {"user_age", "duration_min", "captain_age"}
    doubles = {"distance_km", "fare", "discount_percent", "discount_amount", "final_amount", "user_rating",
               "feedback_captain_rating", "captain_overall_rating"}
    out = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" if c in dates else f"CAST({c} AS BIGINT) AS {c}" if c in numbers
                    else f"CAST({c} AS DOUBLE) AS {c}" if c in doubles else c for c in DASHBOARD_COLUMNS)
    order = ", ".join(f"{c} NULLS LAST" for c in (
        "user_id", "cap", "ride_id", "payment_id", "feedback_id", "fare", "discount_percent", "discount_amount",
        "final_amount", "payment_method", "payment_status", "captain_ride_id"))
    return f""", mine AS (
        SELECT u.user_id, u.name AS user_name, u.gender, u.age AS user_age, u.signup_date, u.city AS user_city,
               r.ride_id, r.captain_id, r.ride_date, r.pickup_loc, r.drop_loc, r.distance_km, r.duration_min, r.ride_status,
               p.payment_id, p.payment_method, p.fare, p.discount_percent, p.discount_amount, p.final_amount, p.payment_status,
               f.feedback_id, f.user_rating, f.captain_rating AS feedback_captain_rating, f.issue_category, f.comments
        FROM s_users u LEFT JOIN s_rides r USING (user_id) LEFT JOIN s_payments p USING (ride_id)
        LEFT JOIN s_feedback f USING (ride_id)
      ), theirs AS (
        SELECT c.captain_id AS cap, c.name AS captain_name, c.age AS captain_age, c.city AS captain_city,
               c.rating AS captain_overall_rating, r.ride_id AS captain_ride_id
        FROM s_captains c LEFT JOIN s_rides r USING (captain_id)
      ), fan AS (
        SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS row_no
        FROM mine FULL JOIN theirs ON mine.captain_id = theirs.cap
      ), total AS (SELECT count(*) AS n FROM fan)
      SELECT row_no, captain_ride_id, {out} FROM fan, total
      WHERE row_no < 400 OR (row_no >= n // 2 AND row_no < n // 2 + 400) OR row_no >= n - 400"""


SQL.update(_sources_sql())
