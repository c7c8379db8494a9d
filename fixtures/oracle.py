"""Expected results as DuckDB SQL over the given tables, one text per registered query.

``TABLES`` states the derivation of the inputs and the shared intermediate tables; each query text is
that list as common table expressions plus one final select. Doubles that a query does not round
itself are rounded to six digits on both sides, as summation order differs between engines.
"""

from __future__ import annotations

from wayfunnel.settings import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, PREDICTION_POINT

TABLES: dict[str, str] = {}

TABLES["base"] = """
select o_orderkey as k, o_custkey as ck, n_name as nation, c_mktsegment as seg, c_acctbal as bal,
  o_orderstatus as st, o_orderpriority as prio, cast(o_orderdate as date) as d, year(o_orderdate) as yr,
  o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as searched_at,
  concat('S', o_custkey, '-', year(o_orderdate)) as session_id,
  (o_custkey + year(o_orderdate)) % 4 as dev,
  case when o_orderkey % 10 < 5 then 'Hub A' when o_orderkey % 10 < 8 then 'Hub B'
       when o_orderkey % 10 < 9 then 'Hub C' else 'Hub D' end as dest
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""

TABLES["opt"] = """
select b.*, l_partkey as pk, l_suppkey as sk, l_extendedprice as fare, l_returnflag as rf,
  row_number() over (partition by k order by md5(concat_ws('-', l_linenumber, l_partkey, l_suppkey)),
                     l_quantity, l_extendedprice, l_shipdate) as pos,
  count(*) over (partition by k) as rc
from lineitem join base b on l_orderkey = k
where l_quantity > case when d between date '1998-03-02' and date '1998-03-29' and dest = 'Hub A'
                        then 30 else 10 end"""

TABLES["device_names"] = """
select unnest(['Desktop Web', 'Mobile Web', 'iOS App', 'Android App']) as device_type,
       unnest([0, 1, 2, 3]) as dev"""

TABLES["raw_sessions"] = """
select session_id, concat('C', ck) as customer_id, min(searched_at) as session_started_at, device_type,
  case when dev = 0 then ['Windows', 'macOS', 'Linux'][1 + ck % 3]
       when dev = 1 then ['iOS', 'Android'][1 + ck % 2] when dev = 2 then 'iOS' else 'Android' end
    as operating_system,
  seg as acquisition_channel, case when ck % 8 < 3 then 'New' else 'Returning' end as customer_type,
  nation as country, case when bal > 2500 then 1 else 0 end as is_logged_in
from base join device_names using (dev)
group by session_id, ck, dev, device_type, seg, nation, bal"""

TABLES["raw_searches"] = """
select concat('Q', k) as search_id, session_id, searched_at, nation as origin_station,
  dest as destination_station, d + cast(k % 61 as int) as travel_date,
  cast(1 + k % 5 as int) as passengers,
  case when prio in ('1-URGENT', '2-HIGH') then 'Single' else 'Return' end as journey_type,
  case when ck % 3 = 0 then 1 else 0 end as railcard_used, cast(coalesce(n, 0) as int) as results_count,
  cast(180 + (k * 31) % 1500 as int) as search_latency_ms,
  case when n is null then 1 else 0 end as zero_results_flag
from base left join (select k, count(*) as n from opt group by k) using (k)"""

TABLES["raw_journey_results"] = """
select concat('R', k, '-', pos) as result_id, concat('Q', k) as search_id,
  concat('Operator ', sk % 10) as operator,
  cast(d + cast(k % 61 as int) as timestamp) + to_hours(cast(5 + pk % 18 as int)) as departure_time,
  cast(d + cast(k % 61 as int) as timestamp) + to_hours(cast(5 + pk % 18 as int))
    + to_minutes(cast(20 + pk % 401 as int)) as arrival_time,
  cast(20 + pk % 401 as int) as duration_minutes, cast(sk % 3 as int) as changes, fare,
  case rf when 'A' then 'Advance' when 'N' then 'Off-Peak' else 'Anytime' end as fare_type,
  cast(pos as int) as result_position,
  case when st in ('F', 'P') and pos = 1 + k % rc then 1 else 0 end as selected_flag
from opt"""

TABLES["attempts"] = """
select *, case when error = 0 and k % 23 = 0 then 1 else 0 end as failure,
  case when error = 0 and k % 23 <> 0 and st = 'F' then 1 else 0 end as done
from (select *, case when k % 19 = 0 or (d between date '1998-06-01' and date '1998-06-28'
                       and dev in (1, 3) and k % 5 = 0) then 1 else 0 end as error
      from opt where st in ('F', 'P') and pos = 1 + k % rc)"""

TABLES["raw_checkout"] = """
select concat('H', k) as checkout_id, session_id, concat('Q', k) as search_id,
  searched_at + to_minutes(cast(2 + k % 17 as int)) as checkout_started_at, device_type,
  ['Debit Card', 'Credit Card', 'Apple Pay', 'Google Pay', 'PayPal'][1 + k % 5] as payment_method,
  error as checkout_error_flag,
  case when error = 0 then 'None' else
    ['Session Timeout', 'Fare Changed', 'Inventory Unavailable', 'Technical Error'][1 + (k + ck) % 4] end
    as error_type,
  failure as payment_failure_flag, done as checkout_completed_flag
from attempts join device_names using (dev)"""

TABLES["raw_bookings"] = """
select concat('B', k) as booking_id, session_id, concat('Q', k) as search_id, concat('H', k) as checkout_id,
  searched_at + to_minutes(cast(3 + k % 17 as int)) as booked_at, fare * (1 + k % 5) as ticket_value,
  case when k % 7 = 0 then 1.49e0 else 0e0 end as booking_fee,
  fare * (1 + k % 5) + case when k % 7 = 0 then 1.49e0 else 0e0 end as total_revenue,
  cast(1 + k % 5 as int) as passengers, concat('Operator ', sk % 10) as operator,
  nation as origin_station, dest as destination_station
from attempts where done = 1"""

TABLES["raw_station_reference"] = """
select concat('RS', n_nationkey) as station_code, n_name as station_name, r_name as region,
  cast(500000 + n_nationkey::bigint * 1000003 as bigint) as annual_entries_exits,
  cast(10000 + n_nationkey::bigint * 70001 as bigint) as interchange_volume
from nation join region on n_regionkey = r_regionkey"""

TABLES["stg_sessions"] = """
select session_id, customer_id, session_started_at, cast(session_started_at as date) as session_date,
  cast(hour(session_started_at) as int) as session_hour, device_type, operating_system,
  acquisition_channel, customer_type, country, is_logged_in
from raw_sessions"""

TABLES["stg_searches"] = """
select search_id, session_id, searched_at, cast(searched_at as date) as search_date,
  cast(hour(searched_at) as int) as search_hour, origin_station, destination_station,
  concat(origin_station, ' → ', destination_station) as route, travel_date,
  cast(travel_date - cast(searched_at as date) as int) as days_before_travel, passengers, journey_type,
  railcard_used, results_count, search_latency_ms, zero_results_flag
from raw_searches"""

TABLES["stg_results"] = "select * from raw_journey_results"

TABLES["stg_checkout"] = """
select *, cast(checkout_started_at as date) as checkout_date from raw_checkout"""

TABLES["stg_bookings"] = "select *, cast(booked_at as date) as booking_date from raw_bookings"

TABLES["stg_stations"] = "select * from raw_station_reference"


def _selected(column: str, alias: str) -> str:
    return f"max({column}) filter (selected_flag = 1) as {alias}"


TABLES["selected_results"] = f"""
select search_id, max(selected_flag) as selected_flag, {_selected('result_id', 'selected_result_id')},
  {_selected('operator', 'selected_operator')}, {_selected('fare', 'selected_fare')},
  {_selected('duration_minutes', 'selected_duration_minutes')}, {_selected('changes', 'selected_changes')}
from stg_results group by search_id"""

TABLES["checkout_summary"] = """
select search_id, 1 as checkout_started_flag, max(checkout_id) as checkout_id,
  max(payment_method) as payment_method, max(checkout_error_flag) as checkout_error_flag,
  max(error_type) as error_type, max(payment_failure_flag) as payment_failure_flag,
  max(checkout_completed_flag) as checkout_completed_flag
from stg_checkout group by search_id"""

TABLES["booking_summary"] = """
select search_id, 1 as booked_flag, max(booking_id) as booking_id, sum(total_revenue) as revenue
from stg_bookings group by search_id"""

TABLES["funnel"] = """
select q.search_id, q.session_id, customer_id, search_date, searched_at, search_hour, device_type,
  operating_system, acquisition_channel, customer_type, country, is_logged_in, origin_station,
  destination_station, route, travel_date, days_before_travel, passengers, journey_type, railcard_used,
  results_count, search_latency_ms, zero_results_flag, (results_count > 0)::int as results_available_flag,
  ifnull(selected_flag, 0) as selected_flag, selected_result_id, selected_operator, selected_fare,
  selected_duration_minutes, selected_changes, ifnull(checkout_started_flag, 0) as checkout_started_flag,
  checkout_id, payment_method, ifnull(checkout_error_flag, 0) as checkout_error_flag, error_type,
  ifnull(payment_failure_flag, 0) as payment_failure_flag,
  ifnull(checkout_completed_flag, 0) as checkout_completed_flag,
  (checkout_id is not null and checkout_error_flag + payment_failure_flag + checkout_completed_flag = 0)::int
    as checkout_abandoned_flag,
  ifnull(booked_flag, 0) as booked_flag, booking_id, ifnull(revenue, 0e0) as revenue,
  case when booking_id is not null then 'Booked' when checkout_id is not null then 'Checkout'
       when selected_flag = 1 then 'Selected' when results_count > 0 then 'Results' else 'Search' end
    as furthest_funnel_stage
from stg_searches q left join stg_sessions using (session_id) left join selected_results using (search_id)
  left join checkout_summary using (search_id) left join booking_summary using (search_id)"""


def rate(numerator: str, denominator: str) -> str:
    return f"round(100e0 * {numerator} / nullif({denominator}, 0), 2)"


def total(flag: str, alias: str) -> str:
    return f"sum({flag})::bigint as {alias}"


def r6(value: str) -> str:
    return f"round({value}, 6) + 0e0"


_ALL = ", ".join(
    total(flag, alias)
    for alias, flag in [
        ("zero_result_searches", "zero_results_flag"),
        ("searches_with_results", "results_available_flag"),
        ("selected_searches", "selected_flag"),
        ("checkout_attempts", "checkout_started_flag"),
        ("checkout_errors", "checkout_error_flag"),
        ("payment_failures", "payment_failure_flag"),
        ("checkout_abandonments", "checkout_abandoned_flag"),
        ("bookings", "booked_flag"),
    ]
)
_ZERO_RATE = rate("sum(zero_results_flag)", "count(*)")
_CONVERSION = rate("sum(booked_flag)", "count(*)")
_SELECTION = rate("sum(selected_flag)", "sum(results_available_flag)")
_ERROR_RATE = rate("sum(checkout_error_flag)", "sum(checkout_started_flag)")
_FAILURE_RATE = rate("sum(payment_failure_flag)", "sum(checkout_started_flag)")
_CHECKOUT_CONVERSION = rate("sum(booked_flag)", "sum(checkout_started_flag)")
_REVENUE = "round(sum(revenue), 2) as revenue"
_LATENCY = "round(avg(search_latency_ms), 2) as avg_search_latency_ms"
# Sums of money are rounded to six digits before they are divided: no noise from summation order.
_ORDER_VALUE = (
    "round(round(sum(revenue) filter (booked_flag = 1), 6) / count(*) filter (booked_flag = 1), 2)"
    " as average_order_value"
)


def _daily(keys: str) -> str:
    return f"""
select search_date as metric_date, {keys} count(*) as searches, count(distinct session_id) as sessions, {_ALL},
  {_REVENUE}, {_ZERO_RATE} as zero_result_rate_pct, {_SELECTION} as result_selection_rate_pct,
  {_ERROR_RATE} as checkout_error_rate_pct, {_FAILURE_RATE} as payment_failure_rate_pct,
  {_CONVERSION} as search_to_book_conversion_pct
from funnel group by all"""


TABLES["kpi"] = f"""
select count(*) as searches, count(distinct session_id) as sessions, {_ALL},
  round(sum(revenue), 2) as total_revenue, {_ORDER_VALUE}, {_ZERO_RATE} as zero_result_rate_pct,
  {_SELECTION} as result_selection_rate_pct, {_CONVERSION} as search_to_book_conversion_pct,
  (select round(avg(b) * 100, 2) from (select max(booked_flag) as b from funnel group by session_id))
    as session_conversion_rate_pct
from funnel"""

TABLES["daily"] = _daily("")
TABLES["daily_routes"] = _daily("route,")

TABLES["routes"] = f"""
select route, origin_station, destination_station, count(*) as searches,
  {total('zero_results_flag', 'zero_result_searches')}, {total('booked_flag', 'bookings')}, {_REVENUE},
  {_LATENCY}, {_ZERO_RATE} as zero_result_rate_pct, {_CONVERSION} as conversion_rate_pct
from funnel group by all having count(*) >= 100"""

_WATCHED = {
    "conversion": "search_to_book_conversion_pct",
    "zero_result": "zero_result_rate_pct",
    "checkout_error": "checkout_error_rate_pct",
}


def _baseline(source: str, partition: str = "") -> str:
    columns = ", ".join(
        f"avg({rate}) over w as {m}_avg_28d, stddev_samp({rate}) over w as {m}_sd_28d"
        for m, rate in _WATCHED.items()
    )
    return f"""
select *, count(*) over w as baseline_days, {columns} from {source}
window w as ({partition} order by metric_date rows between 28 preceding and 1 preceding)"""


def _zscores(source: str) -> str:
    columns = ", ".join(
        f"case when {m}_sd_28d > 0 then ({rate} - {m}_avg_28d) / {m}_sd_28d end as {m}_zscore"
        for m, rate in _WATCHED.items()
    )
    return f"select *, {columns} from {source}"


def _alerts(source: str) -> str:
    return f"""
select *, (baseline_days >= 14 and (ifnull(conversion_zscore, 0) <= -2.5
    or ifnull(zero_result_zscore, 0) >= 2.5 or ifnull(checkout_error_zscore, 0) >= 2.5))::int as alert_flag,
  concat_ws('; ', case when conversion_zscore <= -2.5 then 'Conversion decline' end,
    case when zero_result_zscore >= 2.5 then 'Zero-result spike' end,
    case when checkout_error_zscore >= 2.5 then 'Checkout-error spike' end) as alert_reason
from {source}"""


TABLES["baseline"] = _baseline("daily")
TABLES["zscored"] = _zscores("baseline")
TABLES["alerts"] = _alerts("zscored")
TABLES["route_baseline"] = _baseline("daily_routes", "partition by route")
TABLES["route_zscored"] = _zscores("route_baseline")
TABLES["route_alerts"] = _alerts("route_zscored")

_SIX = [f"{m}_{s}_28d" for m in _WATCHED for s in ("avg", "sd")]
_Z = [f"{m}_zscore" for m in _WATCHED]


def _replaced(columns: list[str], source: str) -> str:
    return f"select * replace ({', '.join(f'{r6(c)} as {c}' for c in columns)}) from {source}"


_ALERT_DAYS = f"""
select metric_date, searches, bookings, revenue, zero_result_rate_pct, checkout_error_rate_pct,
  search_to_book_conversion_pct, {', '.join(f'round({z}, 2) + 0e0 as {z}' for z in _Z)}, alert_reason
from alerts where alert_flag = 1"""

TABLES["supply"] = f"""
select case when search_date >= date '1998-03-02' then 'Incident' else 'Baseline' end as period,
  count(*) as searches, {total('zero_results_flag', 'zero_result_searches')},
  {total('booked_flag', 'bookings')}, {_ZERO_RATE} as zero_result_rate_pct,
  {_CONVERSION} as conversion_rate_pct, {_LATENCY}, {_ORDER_VALUE}, {_REVENUE}
from funnel where 'Hub A' in (origin_station, destination_station)
  and search_date between date '1997-11-10' and date '1998-03-29'
group by 1"""

TABLES["checkout_periods"] = f"""
select case when search_date >= date '1998-06-01' then 'Incident' else 'Baseline' end as period,
  count(*) as searches, {total('checkout_started_flag', 'checkout_attempts')},
  {total('checkout_error_flag', 'checkout_errors')}, {total('payment_failure_flag', 'payment_failures')},
  {total('checkout_abandoned_flag', 'checkout_abandonments')}, {total('booked_flag', 'bookings')},
  {_ERROR_RATE} as checkout_error_rate_pct, {_FAILURE_RATE} as payment_failure_rate_pct,
  {_CHECKOUT_CONVERSION} as checkout_to_booking_rate_pct, {_ORDER_VALUE}, {_REVENUE}
from funnel where device_type in ('Mobile Web', 'Android App')
  and search_date between date '1998-02-09' and date '1998-06-28'
group by 1"""


def _pair(source: str, base: str, events: str) -> str:
    """Both periods on one row, with the pooled z and Cohen's h."""
    return f"""
select b, i, (pa - pb) / sqrt(p * (1 - p) * (1e0 / i.{base} + 1e0 / b.{base})) as z,
  2 * asin(sqrt(pa)) - 2 * asin(sqrt(pb)) as h,
  greatest(i.{base} * (b.bookings / b.{base}::double) - i.bookings, 0) as lost
from (select b, i, i.{events} / i.{base}::double as pa, b.{events} / b.{base}::double as pb,
        (i.{events} + b.{events}) / (i.{base} + b.{base})::double as p
      from {source} b, {source} i where b.period = 'Baseline' and i.period = 'Incident')"""


TABLES["supply_pair"] = _pair("supply", "searches", "zero_result_searches")
TABLES["checkout_pair"] = _pair("checkout_periods", "checkout_attempts", "checkout_errors")

# Two-sided normal tail by Simpson's rule on [|z|, |z| + 12] in 4,000 steps: DuckDB has no erfc.
_P = """(select sqrt(2 / pi()) * 12 / 4000 / 3 * sum(
    case when n in (0, 4000) then 1 when n % 2 = 1 then 4 else 2 end
    * exp(-power(abs(z) + n * 12e0 / 4000, 2) / 2)) from range(4001) t(n))"""

TABLES["supply_impact"] = f"""
select b.zero_result_rate_pct as baseline_zero_result_rate_pct,
  i.zero_result_rate_pct as incident_zero_result_rate_pct,
  round(i.zero_result_rate_pct - b.zero_result_rate_pct, 2) as zero_result_rate_change_pp,
  b.conversion_rate_pct as baseline_conversion_rate_pct, i.conversion_rate_pct as incident_conversion_rate_pct,
  round(i.conversion_rate_pct - b.conversion_rate_pct, 2) as conversion_change_pp,
  b.avg_search_latency_ms as baseline_latency_ms, i.avg_search_latency_ms as incident_latency_ms,
  round(lost, 1) as estimated_lost_bookings,
  round(lost * b.average_order_value, 2) as estimated_revenue_impact,
  round({_P}, 8) as zero_result_test_p_value, round(h, 4) as zero_result_effect_size_cohen_h,
  round({_P}, 8) < 0.05 as significant
from supply_pair"""

TABLES["checkout_impact"] = f"""
select b.checkout_error_rate_pct as baseline_checkout_error_rate_pct,
  i.checkout_error_rate_pct as incident_checkout_error_rate_pct,
  round(i.checkout_error_rate_pct - b.checkout_error_rate_pct, 2) as checkout_error_change_pp,
  b.checkout_to_booking_rate_pct as baseline_checkout_conversion_pct,
  i.checkout_to_booking_rate_pct as incident_checkout_conversion_pct,
  round(i.checkout_to_booking_rate_pct - b.checkout_to_booking_rate_pct, 2) as checkout_conversion_change_pp,
  round(lost, 1) as estimated_lost_bookings,
  round(lost * b.average_order_value, 2) as estimated_revenue_impact,
  round({_P}, 8) as checkout_error_test_p_value, round(h, 4) as checkout_error_effect_size_cohen_h,
  round({_P}, 8) < 0.05 as significant
from checkout_pair"""

TABLES["overall"] = f"""
select count(*) as searches, {total('results_available_flag', 'searches_with_results')},
  {total('selected_flag', 'selected_searches')}, {total('checkout_started_flag', 'checkout_attempts')},
  {total('booked_flag', 'bookings')},
  {rate('sum(results_available_flag)', 'count(*)')} as results_available_rate_pct,
  {_SELECTION} as selection_rate_pct, {_CHECKOUT_CONVERSION} as checkout_to_booking_rate_pct,
  {_CONVERSION} as search_to_book_rate_pct, {_REVENUE}
from funnel"""

TABLES["dataset"] = f"""
select f.search_id, q.searched_at, f.booked_flag, s.device_type, s.operating_system, s.acquisition_channel,
  s.customer_type, s.country, q.origin_station, q.destination_station, q.journey_type, s.is_logged_in,
  q.passengers, q.railcard_used, q.results_count, q.search_latency_ms::double as search_latency_ms,
  q.zero_results_flag, q.days_before_travel, hour(q.searched_at)::int as search_hour,
  dayofweek(q.searched_at)::int as day_of_week, month(q.searched_at)::int as search_month
from funnel f join stg_searches q using (search_id) join stg_sessions s on q.session_id = s.session_id"""

TABLES["labelled"] = """
select *, case when searched_at < timestamp '1999-01-01' then 'train'
               when searched_at < timestamp '2000-01-01' then 'validation' else 'test' end as split
from dataset"""

_FORMULA = """least(search_latency_ms * 0.0002e0 + results_count * 0.03e0 + railcard_used * 0.15e0
  + is_logged_in * 0.05e0, 0.95e0)"""

TABLES["scored"] = f"select *, {_FORMULA} as score from dataset"
TABLES["tied"] = """
select *, case when results_count >= 3 then 0.3e0 else results_count * 0.1e0 + railcard_used * 0.05e0 end
  as score from dataset"""


def _curve(source: str, by: str = "") -> str:
    """Running totals over distinct scores, highest first."""
    keys = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f"""
select *, sum(n) over w as cum_n, sum(pos) over w as cum_pos
from (select {keys}score, count(*) as n, sum(booked_flag) as pos from {source} group by {keys}score)
window w as ({part} order by score desc rows unbounded preceding)"""


TABLES["curve"] = _curve("scored")
TABLES["tied_curve"] = _curve("tied")


def _metrics(curve: str) -> str:
    return f"""
select {r6('sum((n - pos) * (cum_pos - pos / 2e0)) / (sum(pos)::double * sum(n - pos))')} as roc_auc,
  {r6('sum(pos * cum_pos / cum_n::double) / sum(pos)')} as pr_auc,
  {r6('-sum(pos * ln(p) + (n - pos) * ln(1 - p)) / sum(n)')} as log_loss,
  {r6('sum(pos * (1 - score) * (1 - score) + (n - pos) * score * score) / sum(n)')} as brier_score,
  {r6('sum(case when score >= 0.5 then pos else n - pos end) / sum(n)::double')} as accuracy,
  {r6('ifnull(hit / nullif(chosen, 0)::double, 0)')} as precision_050,
  {r6('ifnull(hit / nullif(sum(pos), 0)::double, 0)')} as recall_050,
  {r6('ifnull(2 * hit / nullif(chosen + sum(pos), 0)::double, 0)')} as f1_050
from (select *, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) as p,
        ifnull(sum(pos) filter (score >= 0.5) over (), 0) as hit,
        ifnull(sum(n) filter (score >= 0.5) over (), 0) as chosen
      from {curve})
group by hit, chosen"""


# Unrounded thresholds, as text that reads back to the same doubles.
_THRESHOLDS = """
select round(t, 2) as threshold, t from (select 0.1e0 + n * ((0.1e0 + 0.05e0) - 0.1e0) as t from range(15) r(n))"""

TABLES["thresholds"] = f"""
select threshold, round(100e0 * chosen / n, 2) as predicted_positive_rate_pct,
  {r6('ifnull(hit / nullif(chosen, 0)::double, 0)')} as precision,
  {r6('ifnull(hit / nullif(positives, 0)::double, 0)')} as recall,
  {r6('ifnull(2 * hit / nullif(chosen + positives, 0)::double, 0)')} as f1
from (select threshold, count(*) as n, sum(booked_flag) as positives, count(*) filter (score >= t) as chosen,
        ifnull(sum(booked_flag) filter (score >= t), 0) as hit
      from ({_THRESHOLDS}), scored group by threshold)"""


def _ranked(source: str) -> str:
    return f"""
select *, row_number() over (order by score desc, md5(search_id), search_id) - 1 as rank,
  count(*) over () as total from {source}"""


TABLES["ranked"] = _ranked("scored")
TABLES["tied_ranked"] = _ranked("tied")


def _deciles(ranked: str) -> str:
    return f"""
select greatest(1, (10 * rank + total - 2) // (total - 1))::int as decile, count(*) as searches,
  {total('booked_flag', 'bookings')}, {r6('avg(booked_flag)')} as actual_booking_rate,
  {r6('avg(score)')} as avg_predicted_probability, {r6('avg(booked_flag) * 100')} as actual_booking_rate_pct,
  {r6('avg(score) * 100')} as avg_predicted_probability_pct
from {ranked} group by 1"""


def _lift(ranked: str) -> str:
    return f"""
select round(overall * 100, 2) as overall_test_booking_rate_pct,
  round(best * 100, 2) as top_decile_booking_rate_pct, round(best / overall, 3) as top_decile_lift
from (select avg(booked_flag) as overall,
        avg(booked_flag) filter (rank < greatest(1, floor(total * 0.1e0))) as best from {ranked})"""


def _calibration(source: str) -> str:
    return f"""
select bin, {r6('avg(score)')} as mean_predicted_probability, {r6('avg(booked_flag)')} as observed_booking_rate
from (select score, booked_flag, list_sum([(e < score)::int for e in edges])::int as bin
      from {source}, (
        select [case when h - floor(h) >= 0.5
                     then s[ceil(h)::bigint + 1]
                          - (s[ceil(h)::bigint + 1] - s[floor(h)::bigint + 1]) * (1 - (h - floor(h)))
                     else s[floor(h)::bigint + 1]
                          + (s[ceil(h)::bigint + 1] - s[floor(h)::bigint + 1]) * (h - floor(h)) end
                for h in [n * 0.1e0 * 100 / 100 * (len(s) - 1) for n in range(1, 10)]] as edges
        from (select list(score order by score) as s from {source})))
group by bin"""


TABLES["train"] = "select * from labelled where split = 'train'"


def _imputation(train: str = "train") -> str:
    text = [
        f"select '{c}' as feature, (select {c} from {train} where {c} is not null group by {c} "
        f"order by count(*) desc, {c} limit 1) as text_value, null::double as number_value"
        for c in CATEGORICAL_FEATURES
    ]
    numbers = [
        f"select '{c}', null, (select median(nullif({c}::double, 'nan'::double)) from {train})"
        for c in NUMERIC_FEATURES
    ]
    return " union all ".join(text + numbers)


TABLES["requests"] = """
select * exclude (booked_flag, searched_at) replace (
  days_before_travel * 7 as days_before_travel,
  case when search_latency_ms % 50 = 0 then 0 when search_latency_ms % 60 = 7 then 1.5
    else passengers end::double as passengers,
  case when search_latency_ms % 80 <> 9 then search_latency_ms else 'nan'::double end
    as search_latency_ms,
  case when search_latency_ms % 40 = 1 then 1 - zero_results_flag else zero_results_flag end as zero_results_flag,
  case when search_latency_ms % 70 <> 3 then country end as country)
from dataset"""

_RANGES = {
    "is_logged_in": "between 0 and 1",
    "passengers": "between 1 and 20",
    "railcard_used": "between 0 and 1",
    "results_count": ">= 0",
    "search_latency_ms": ">= 0",
    "zero_results_flag": "between 0 and 1",
    "days_before_travel": "between 0 and 365",
    "search_hour": "between 0 and 23",
    "day_of_week": "between 0 and 6",
    "search_month": "between 1 and 12",
}


def _rules() -> list[tuple[str, str]]:
    rules = [(f"{c}: missing value", f"{c} is null") for c in FEATURES]
    rules += [(f"{c}: out of range", f"not ({c} {limits}) or isnan({c}::double)") for c, limits in _RANGES.items()]
    rules += [
        (f"{c}: not a whole number", f"not isnan({c}::double) and {c} <> floor({c})")
        for c in _RANGES
        if c != "search_latency_ms"
    ]
    rules += [
        (
            "results_count: above 0 in a search flagged empty",
            "zero_results_flag = 1 and results_count <> 0",
        ),
        (
            "results_count: 0 in a search not flagged empty",
            "zero_results_flag = 0 and results_count = 0",
        ),
    ]
    return rules


def _violations() -> str:
    parts = [f"select '{r}' as rule, count(*) as violations from requests where {w}" for r, w in _rules()]
    return f"select * from ({' union all '.join(parts)}) where violations > 0"


# Damaged copies of the tables, so that the checks have something to count.
TABLES["bad_sessions"] = """
select * from stg_sessions where session_hour <> 3 union all
select * from stg_sessions where session_hour = 5"""
TABLES["bad_searches"] = """
select * replace (case when search_latency_ms % 90 = 0 then 1 - zero_results_flag else zero_results_flag end
  as zero_results_flag)
from stg_searches where search_hour <> 4 union all
select * from stg_searches where search_latency_ms % 200 = 7"""
TABLES["bad_results"] = """
select * replace (case when changes = 1 and duration_minutes % 9 = 0 then 1 else selected_flag end as selected_flag)
from stg_results union all select * from stg_results where duration_minutes = 77"""
TABLES["bad_checkout"] = """
select * from stg_checkout where hour(checkout_started_at) <> 9 union all
select * from stg_checkout where hour(checkout_started_at) = 11"""
TABLES["bad_bookings"] = """
select * from stg_bookings union all select * from stg_bookings where hour(booked_at) = 13"""
TABLES["bad_funnel"] = """
select * replace (case when search_latency_ms % 30 = 0 then 1 else selected_flag end as selected_flag,
  case when search_latency_ms % 70 = 0 then 0 else checkout_completed_flag end as checkout_completed_flag)
from funnel"""


def _repeated(table: str, key: str) -> str:
    return f"select {key} from {table} group by {key} having count(*) > 1"


def _orphaned(child: str, key: str, parent: str) -> str:
    return f"select 1 from {child} c where not exists (select 1 from {parent} p where p.{key} = c.{key})"


_CHECKS = {
    "duplicate_sessions": _repeated("bad_sessions", "session_id"),
    "orphan_searches": _orphaned("bad_searches", "session_id", "bad_sessions"),
    "duplicate_searches": _repeated("bad_searches", "search_id"),
    "orphan_results": _orphaned("bad_results", "search_id", "bad_searches"),
    "orphan_checkout": _orphaned("bad_checkout", "search_id", "bad_searches"),
    "zero_flag_consistency": (
        "select 1 from bad_searches where zero_results_flag <> (results_count = 0)::int"
    ),
    "one_selection_per_search": (
        "select 1 from bad_results group by search_id having sum(selected_flag) > 1"
    ),
    "duplicate_checkouts": _repeated("bad_checkout", "checkout_id"),
    "orphan_bookings": _orphaned("bad_bookings", "checkout_id", "bad_checkout"),
    "duplicate_results": _repeated("bad_results", "result_id"),
    "duplicate_bookings": _repeated("bad_bookings", "booking_id"),
    "invalid_funnel_order": (
        "select 1 from bad_funnel where selected_flag > results_available_flag"
        " or checkout_started_flag > selected_flag or booked_flag > checkout_completed_flag"
    ),
    "zero_result_selected": (
        "select 1 from bad_funnel where zero_results_flag = 1 and selected_flag = 1"
    ),
}


def _checks(names: list[str], with_status: bool) -> str:
    parts = [
        f"select '{n}' as \"check\", count(*) as violations from ({_CHECKS[n]})" for n in names
    ]
    status = ", case violations when 0 then 'PASS' else 'FAIL' end as status" if with_status else ""
    return f"select *{status} from ({' union all '.join(parts)})"


_KEYS = {
    "sessions": "session_id",
    "searches": "search_id",
    "journey_results": "result_id",
    "checkout": "checkout_id",
    "bookings": "booking_id",
    "station_reference": "station_code",
}


def _contract() -> str:
    return " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, count(*) filter ({k} is null) as null_keys, "
        f"(select count(*) from ({_repeated('raw_' + t, k)} and {k} is not null)) as duplicate_keys, "
        f"'' as missing_columns, '' as mistyped_columns from raw_{t}"
        for t, k in _KEYS.items()
    )


_SEED, _REPEATS = 42, 3

TABLES["sampled"] = f"""
select search_id, booked_flag, {', '.join(FEATURES)}, row_number() over (order by h, search_id) as position
from (select *, md5(concat_ws(':', '{_SEED}', search_id)) as h from dataset)"""

TABLES["donors"] = f"""
select repeat, {', '.join(FEATURES)},
  row_number() over (partition by repeat
                     order by md5(concat_ws(':', '{_SEED}', repeat, search_id)), search_id) as position
from sampled, range({_REPEATS}) t(repeat)"""


def _permuted() -> str:
    used = ("search_latency_ms", "results_count", "railcard_used", "is_logged_in")
    columns = ", ".join(
        f"case when feature = '{f}' then d.{f} else s.{f} end as {f}" for f in used
    )
    names = ", ".join(f"'{f}'" for f in FEATURES)
    return f"""
select feature, repeat, booked_flag, {_FORMULA} as score from (
  select feature, repeat, booked_flag, {columns}
  from sampled s join donors d using (position), (select unnest([{names}]) as feature))
union all select '(none)', 0, booked_flag, {_FORMULA} from sampled"""


TABLES["permuted"] = _permuted()
TABLES["permuted_curve"] = _curve("permuted", "feature, repeat")
TABLES["permuted_ap"] = """
select feature, repeat, sum(pos * cum_pos / cum_n::double) / sum(pos) as ap from permuted_curve
group by feature, repeat"""

_IMPORTANCE = f"""
select feature, {r6('avg(b - ap)')} as importance_mean, {r6('stddev_pop(b - ap)')} as importance_std
from permuted_ap, (select ap as b from permuted_ap where feature = '(none)')
where feature <> '(none)' group by feature"""

_PROFILE = """
select (select count(*) from stg_sessions) as sessions, (select count(*) from stg_searches) as searches,
  (select count(*) from stg_results) as journey_results, (select count(*) from stg_checkout) as checkout_attempts,
  (select count(*) from stg_bookings) as bookings,
  (select round(count(distinct session_id)::double / (select count(distinct session_id) from stg_sessions), 6)
     from stg_bookings) as session_conversion_rate,
  (select round(count(*)::double / (select count(*) from stg_searches), 6) from stg_bookings)
    as search_to_book_conversion_rate,
  (select round(avg(zero_results_flag), 6) from stg_searches) as zero_result_rate,
  (select round(avg(checkout_error_flag), 6) from stg_checkout) as checkout_error_rate,
  (select round(avg(payment_failure_flag), 6) from stg_checkout) as payment_failure_rate,
  (select round(sum(total_revenue), 2) from stg_bookings) as total_revenue"""

_DEVICE = f"""
select device_type, count(*) as searches, count(distinct session_id) as sessions,
  {total('zero_results_flag', 'zero_result_searches')}, {total('checkout_started_flag', 'checkout_attempts')},
  {total('checkout_error_flag', 'checkout_errors')}, {total('payment_failure_flag', 'payment_failures')},
  {total('booked_flag', 'bookings')}, {_REVENUE}, {_CONVERSION} as conversion_rate_pct,
  {_ERROR_RATE} as checkout_error_rate_pct
from funnel group by device_type"""

_CHANNEL = f"""
select acquisition_channel, count(*) as searches, count(distinct session_id) as sessions,
  {total('booked_flag', 'bookings')}, {_REVENUE}, {_CONVERSION} as conversion_rate_pct,
  round(round(sum(revenue), 6) / count(distinct session_id), 2) as revenue_per_session
from funnel group by acquisition_channel"""

_ZERO = f"""
select route, count(*) as searches, {total('zero_results_flag', 'zero_result_searches')},
  {_ZERO_RATE} as zero_result_rate_pct, {_LATENCY},
  round(avg(days_before_travel), 2) as avg_days_before_travel
from funnel group by route having count(*) >= 100"""

_FAILURES = f"""
select device_type, payment_method, ifnull(error_type, 'None') as error_type, count(*) as checkout_attempts,
  {total('checkout_error_flag', 'checkout_errors')}, {total('payment_failure_flag', 'payment_failures')},
  {total('checkout_abandoned_flag', 'checkout_abandonments')}, {total('booked_flag', 'bookings')},
  {_ERROR_RATE} as checkout_error_rate_pct, {_FAILURE_RATE} as payment_failure_rate_pct,
  {_CHECKOUT_CONVERSION} as checkout_to_booking_rate_pct
from funnel where checkout_started_flag = 1 group by 1, 2, 3"""

_IMPACT = """
select issue_type, affected_searches, round(v, 2) as benchmark_avg_order_value,
  round(affected_searches * v, 2) as estimated_revenue_at_risk
from (select unnest(['Zero-result searches', 'Checkout errors', 'Payment failures', 'Checkout abandonment'])
          as issue_type,
        unnest([sum(zero_results_flag), sum(checkout_error_flag), sum(payment_failure_flag),
                sum(checkout_abandoned_flag)])::bigint as affected_searches from funnel),
     (select round(sum(total_revenue), 6) / count(*) as v from stg_bookings)"""

_SEGMENT = f"""
select device_type, customer_type, is_logged_in, count(*) as searches, {total('booked_flag', 'bookings')},
  {_CONVERSION} as conversion_rate_pct, {_ZERO_RATE} as zero_result_rate_pct,
  {_ERROR_RATE} as checkout_error_rate_pct, {_REVENUE}
from funnel group by 1, 2, 3"""

_OPPORTUNITIES = """
select route, searches, zero_result_searches, zero_result_rate_pct, conversion_rate_pct, revenue,
  avg_search_latency_ms
from routes where searches >= 200 order by zero_result_rate_pct desc, searches desc, route limit 20"""

_DOCUMENTED = f"""
select count(*) as sessions, {rate('sum(started)', 'count(*)')} as checkout_start_rate_pct,
  {rate('sum(completed)', 'sum(attempts)')} as checkout_completion_rate_pct,
  {rate('sum(1 - booked)', 'count(*)')} as funnel_abandonment_rate_pct,
  round(round(sum(revenue), 6) / count(*), 2) as revenue_per_session
from (select max(checkout_started_flag) as started, max(booked_flag) as booked,
        sum(checkout_started_flag) as attempts, sum(checkout_completed_flag) as completed,
        sum(revenue) as revenue from funnel group by session_id)"""

_SESSION_FEATURES = f"""
select session_id, customer_id, count(*) as searches, {total('zero_results_flag', 'zero_result_searches')},
  {total('selected_flag', 'selected_searches')}, {total('checkout_started_flag', 'checkout_attempts')},
  {total('booked_flag', 'bookings')}, {_REVENUE}
from funnel group by session_id, customer_id"""

# Sessions on the outer side, searches of some hours left out.
TABLES["some_funnel"] = "select * from funnel where search_hour < 4 or search_hour > 9"
TABLES["all_sessions"] = """
select s.session_id, s.customer_id, count(f.search_id) as searches,
  coalesce(sum(zero_results_flag), 0)::bigint as zero_result_searches,
  coalesce(sum(selected_flag), 0)::bigint as selected_searches,
  coalesce(sum(checkout_started_flag), 0)::bigint as checkout_attempts,
  coalesce(sum(booked_flag), 0)::bigint as bookings, coalesce(max(checkout_started_flag), 0) as started,
  coalesce(max(booked_flag), 0) as booked, sum(checkout_completed_flag) as completed,
  coalesce(sum(f.revenue), 0) as revenue
from stg_sessions s left join some_funnel f on f.session_id = s.session_id
group by s.session_id, s.customer_id"""
_ALL_SESSIONS = """
select session_id, customer_id, searches, zero_result_searches, selected_searches, checkout_attempts,
  bookings, round(revenue, 2) as revenue
from all_sessions"""
_ALL_DOCUMENTED = f"""
select count(*) as sessions, {rate('sum(started)', 'count(*)')} as checkout_start_rate_pct,
  {rate('sum(completed)', 'sum(checkout_attempts)')} as checkout_completion_rate_pct,
  {rate('sum(1 - booked)', 'count(*)')} as funnel_abandonment_rate_pct,
  round(round(sum(revenue), 6) / count(*), 2) as revenue_per_session
from all_sessions"""

_EDGES = [
    ("searches", "session_id", "sessions"),
    ("journey_results", "search_id", "searches"),
    ("checkout", "session_id", "sessions"),
    ("checkout", "search_id", "searches"),
    ("bookings", "session_id", "sessions"),
    ("bookings", "search_id", "searches"),
    ("bookings", "checkout_id", "checkout"),
]


def _foreign_keys(prefix: str) -> str:
    def table(name: str) -> str:
        return prefix + name.removeprefix("journey_")

    return " union all ".join(
        f"select '{child}' as table_name, '{key}' as column_name, '{parent}' as parent_table, "
        f"count(*) as row_count, count(*) - count({key}) as null_keys, "
        f"count(*) filter ({key} is null or {key} not in (select {key} from {table(parent)})) as orphans "
        f"from {table(child)}"
        for child, key, parent in _EDGES
    )


# Encodings of the validation rows by what the training rows hold.
TABLES["bad_train"] = """
select * replace (
  case when search_latency_ms % 7 <> 0 then search_latency_ms else 'nan'::double end as search_latency_ms,
  case when search_latency_ms % 11 <> 0 then results_count end as results_count,
  case when search_latency_ms % 5 <> 0 then country end as country)
from train"""
TABLES["encodable"] = """
select * replace (case when search_latency_ms % 9 = 0 then 'Nowhere' else country end as country)
from labelled where split = 'validation'"""


def _encoded(ordinal: bool) -> str:
    parts = []
    for c in CATEGORICAL_FEATURES:
        levels = f"(select list(distinct {c} order by {c}) from train)"
        place = f"list_position({levels}, {c})"
        shown = f"{place} - 1" if ordinal else f"(case when {place} is null then 0 else 1 end)"
        level = "" if ordinal else f"case when {place} is not null then {c} end as level, "
        code = f"coalesce({shown}, -1)" if ordinal else shown
        parts.append(f"select search_id, '{c}' as feature, {level}{code}::double as value from encodable")
    for c in NUMERIC_FEATURES:
        spread = f"(select nullif(stddev_samp({c}::double), 0) from train)"
        scaled = f"coalesce(({c}::double - (select avg({c}::double) from train)) / {spread}, 0)"
        value = f"{c}::double" if ordinal else f"round({scaled}, 6) + 0e0"
        level = "" if ordinal else "null as level, "
        parts.append(f"select search_id, '{c}', {level}{value} from encodable")
    return " union all ".join(parts)


_CHECKED_JOIN = """
select search_id, checkout_id, session_id, selected_operator, selected_fare, customer_type, country
from stg_checkout left join selected_results using (search_id) left join stg_sessions using (session_id)"""

_INVESTIGATION = """
select o.searches, o.search_to_book_rate_pct, o.revenue,
  s.estimated_lost_bookings as supply_lost_bookings, s.estimated_revenue_impact as supply_revenue_impact,
  c.estimated_lost_bookings as checkout_lost_bookings, c.estimated_revenue_impact as checkout_revenue_impact,
  (select count(*) from alerts where alert_flag = 1) as anomaly_alert_days
from overall o, supply_impact s, checkout_impact c"""


def _two_feature_tree() -> str:
    """One tree of at most three leaves over two features, second-order gains, penalty of 0.5, 40
    rows a leaf: every split of the root, the best, every split of its children, the better one."""

    def splits(name: str, cells: str, by: str) -> str:
        over = f"partition by {by}, f order by v"
        whole = f"partition by {by}, f"
        parts = {
            "left": ("gl", "hl", "nl"),
            "rest": ("gt - gl", "ht - hl", "nt - nl"),
        }
        worth = " + ".join(f"pow({g}, 2) / ({h} + 0.5)" for g, h, _ in parts.values())
        return f"""{name}_sums as (
  select {by}, f, v, sum(g) as g, sum(h) as h, sum(n) as n
  from (select *, 0 as f, a as v from {cells} union all select *, 1 as f, b as v from {cells})
  group by {by}, f, v
), {name}_splits as (
  select {by}, f, v, sum(g) over ({over}) as gl, sum(h) over ({over}) as hl, sum(n) over ({over}) as nl,
         sum(g) over ({whole}) as gt, sum(h) over ({whole}) as ht, sum(n) over ({whole}) as nt
  from {name}_sums
), {name}_best as (
  select {by}, f, v, {worth} - pow(gt, 2) / (ht + 0.5) as gain
  from {name}_splits where least(nl, nt - nl) >= 40
  qualify row_number() over (partition by {by} order by gain desc, f, v) = 1 and gain > 0
)"""

    goes = "case when {0}.f = 0 then {1}.a else {1}.b end"
    return f""", fit as (select * from train where not ({_HELD_OUT})),
prior as (select avg(booked_flag) as p from fit),
cells as (
  select 0 as node, railcard_used::double as a, results_count::double as b, count(*) as n,
         sum(p - booked_flag) as g, sum(p * (1 - p)) as h
  from fit, prior group by railcard_used, results_count
), edges as (
  select f, v, v + (lead(v) over (partition by f order by v) - v) / 2 as edge
  from (select distinct 0 as f, a as v from cells union select distinct 1 as f, b as v from cells)
), {splits("root", "cells", "node")},
root as (select r.f, e.edge from root_best r join edges e using (f, v)),
halves as (
  select c.* replace (case when {goes.format("r", "c")} <= r.edge then 1 else 2 end as node)
  from cells c, root r
), {splits("half", "halves", "node")},
half as (
  select h.node, h.f, e.edge from half_best h join edges e using (f, v)
  order by gain desc, node limit 1
),
asked as (
  select search_id, railcard_used::double as a, results_count::double as b, split from labelled
), leaves as (
  select q.*, coalesce(case when h.node is not null and {goes.format("h", "q")} <= h.edge then 1 end, 0) as part
  from (select c.* replace (case when {goes.format("r", "c")} <= r.edge then 1 else 2 end as node)
        from (select 0 as node, null as search_id, a, b, n, g, h from cells
              union all select 0, search_id, a, b, null, null, null from asked where split = 'validation') c,
             root r) q
  left join half h on h.node = q.node
), leaf_values as (select node, part, -sum(g) / (sum(h) + 0.5) as value from leaves group by node, part)
select search_id, round(1 / (1 + exp(-(ln(p / (1 - p)) + value))), 4) + 0e0 as score
from leaves join leaf_values using (node, part), prior where search_id is not null"""


FINAL: dict[str, str] = {
    "contract_check": _contract(),
    "source_profile": _PROFILE,
    "stg_sessions": "select * from stg_sessions",
    "stg_searches": "select * from stg_searches",
    "stg_results": "select * from stg_results",
    "stg_checkout": "select * from stg_checkout",
    "stg_bookings": "select * from stg_bookings",
    "stg_stations": "select * from stg_stations",
    "selected_results": "select * from selected_results",
    "checkout_summary": "select * from checkout_summary",
    "booking_summary": "select * from booking_summary",
    "search_funnel": "select * from funnel",
    "kpi_summary": "select * from kpi",
    "warehouse_summary": (
        "select *, (select count(*) from alerts where alert_flag = 1) as anomaly_alert_days from kpi"
    ),
    "daily_funnel": "select * from daily",
    "device_performance": _DEVICE,
    "channel_performance": _CHANNEL,
    "route_performance": "select * from routes",
    "zero_result_analysis": _ZERO,
    "checkout_failure_analysis": _FAILURES,
    "commercial_impact": _IMPACT,
    "overall_funnel": "select * from overall",
    "segment_performance": _SEGMENT,
    "route_opportunities": _OPPORTUNITIES,
    "documented_metrics": _DOCUMENTED,
    "session_features": _SESSION_FEATURES,
    "checked_join": _CHECKED_JOIN,
    "rolling_baseline": _replaced(_SIX, "baseline"),
    "zscores": _replaced(_SIX + _Z, "zscored"),
    "daily_anomaly_alerts": _replaced(_SIX + _Z, "alerts"),
    "route_anomaly_alerts": _replaced(_SIX + _Z, "route_alerts"),
    "anomaly_alert_days": _ALERT_DAYS,
    "daily_metrics": f"select metric_date, {', '.join(_WATCHED.values())} from daily",
    "alert_reconciliation": (
        "select 'alert_count_reconciliation' as \"check\", 0::bigint as violations"
    ),
    "dq_report": _checks(list(_CHECKS), True),
    "dq_orphans": _checks([n for n in _CHECKS if n.startswith("orphan_")], False),
    "dq_model_dataset": """
select 'duplicate_search_ids' as "check", count(*) as violations
from (select 1 from dataset group by search_id having count(*) > 1)
union all select 'target_not_binary', count(*) from dataset where booked_flag not in (0, 1)""",
    "dq_splits": """
select unnest(['train_empty', 'validation_empty', 'test_empty', 'train_overlaps_validation',
               'validation_overlaps_test']) as "check",
  unnest([(a is null)::int, (b is null)::int, (d is null)::int, (a >= b)::int, (c >= d)::int])::bigint
    as violations
from (select max(searched_at) filter (split = 'train') as a, min(searched_at) filter (split = 'validation') as b,
        max(searched_at) filter (split = 'validation') as c, min(searched_at) filter (split = 'test') as d
      from labelled)""",
    "supply_incident": "select * from supply",
    "checkout_incident": "select * from checkout_periods",
    "proportion_test": f"select {r6('z')} as z_statistic, {r6(_P)} as p_value from checkout_pair",
    "effect_size": f"select {r6('h')} as cohen_h from checkout_pair",
    "supply_impact": "select * from supply_impact",
    "checkout_impact": "select * from checkout_impact",
    "investigation_summary": _INVESTIGATION,
    "model_dataset": "select * from dataset",
    "model_rows": "select * from dataset",
    "temporal_split": (
        "select split, count(*) as row_count, round(avg(booked_flag) * 100, 2) as booking_rate_pct"
        " from labelled group by split"
    ),
    "imputation_values": _imputation(),
    "prior_scores": (
        f"select search_id, {r6('(select avg(booked_flag) from train)')} as score"
        " from labelled where split = 'validation'"
    ),
    "model_metrics": _metrics("curve"),
    "model_metrics_tied": _metrics("tied_curve"),
    "threshold_analysis": "select * from thresholds",
    "best_threshold": "select * from thresholds order by f1 desc, threshold limit 1",
    "decile_analysis": _deciles("ranked"),
    "decile_analysis_tied": _deciles("tied_ranked"),
    "top_decile_lift": _lift("ranked"),
    "top_decile_lift_tied": _lift("tied_ranked"),
    "calibration": _calibration("scored"),
    "calibration_tied": _calibration("tied"),
    "roc_curve": f"""
select {r6('score')} as threshold, {r6('(cum_n - cum_pos) / (sum(n - pos) over ())::double')} as fpr,
  {r6('cum_pos / (sum(pos) over ())::double')} as tpr from curve""",
    "pr_curve": f"""
select {r6('score')} as threshold, {r6('cum_pos / cum_n::double')} as precision,
  {r6('cum_pos / (sum(pos) over ())::double')} as recall from curve""",
    "permutation_importance": _IMPORTANCE,
    "score_validation": _violations(),
}


TABLES["tested"] = f"select *, {_FORMULA} as score from labelled where split = 'test'"
TABLES["tested_curve"] = _curve("tested")
TABLES["checked"] = f"select *, {_FORMULA} as score from labelled where split = 'validation'"
TABLES["checked_curve"] = _curve("checked")
TABLES["stepped"] = """
select t.* from tied t join labelled l using (search_id) where l.split = 'validation'"""
TABLES["stepped_curve"] = _curve("stepped")
TABLES["compared"] = f"""
select 'Formula' as model, * from ({_metrics('checked_curve')}) union all
select 'Steps' as model, * from ({_metrics('stepped_curve')})"""
TABLES["chosen_threshold"] = f"""
select round(t, 2) as threshold
from ({_THRESHOLDS}), tested group by t
order by ifnull(2 * ifnull(sum(booked_flag) filter (score >= t), 0)
  / nullif(count(*) filter (score >= t) + sum(booked_flag), 0)::double, 0) desc, threshold limit 1"""

# One feature: the logistic fit gives its group's rate; one boosting step with two leaves gives
# the logit 2 (2 r - 1) of the rows that were not held out.
_HELD_OUT = "('0x' || substr(md5(search_id), 1, 8))::bigint % 10 = 0"

FINAL |= {
    "alert_reconciliation": f"""
select 'alert_count_reconciliation' as "check",
  ((select count(*) from ({_ALERT_DAYS})) <> (select sum(alert_flag) from alerts))::bigint as violations""",
    "alert_reconciliation_damaged": f"""
select 'alert_count_reconciliation' as "check",
  ((select count(*) from ({_ALERT_DAYS}) where day(metric_date) <= 7)
    <> (select sum(alert_flag) from alerts))::bigint as violations""",
    "contract_check_damaged": """
select * from (with searches_with_loss as (
  select case when search_latency_ms % 40 <> 3 then search_id end as search_id from raw_searches),
twice as (select * from raw_checkout union all
          select * from raw_checkout where hour(checkout_started_at) = 11),
keyed as (
  select 'sessions' as t, session_id as k from raw_sessions union all
  select 'searches', search_id from searches_with_loss union all
  select 'journey_results', result_id from raw_journey_results union all
  select 'checkout', checkout_id from twice union all
  select 'bookings', booking_id from raw_bookings union all
  select 'station_reference', station_code from raw_station_reference)
select t as table_name, sum(n)::bigint as row_count, ifnull(sum(n) filter (k is null), 0)::bigint as null_keys,
  count(*) filter (k is not null and n > 1) as duplicate_keys,
  case t when 'searches' then 'railcard_used' else '' end as missing_columns,
  case t when 'searches' then 'results_count' else '' end as mistyped_columns
from (select t, k, count(*) as n from keyed group by t, k) group by t)""",
    "dq_model_dataset_damaged": """
select 'duplicate_search_ids' as "check", count(*) filter (search_latency_ms % 200 = 7) as violations
from dataset
union all select 'target_not_binary', count(*) filter (search_latency_ms % 90 = 0) from dataset""",
    "dq_splits_damaged": """
select unnest(['train_empty', 'validation_empty', 'test_empty', 'train_overlaps_validation',
               'validation_overlaps_test']) as "check",
  unnest([(a is null)::int, (b is null)::int, 1, ifnull((a >= b)::int, 0), 0])::bigint as violations
from (select max(searched_at) filter (split <> 'validation') as a,
        min(searched_at) filter (split = 'validation') as b from labelled)""",
    "formula_test_predictions": f"""
select search_id, searched_at, booked_flag, {r6('score')} as booking_probability,
  (score >= 0.5)::int as predicted_booking_050 from tested""",
    "formula_comparison": "select * from compared",
    "formula_batch_scoring": f"""
select search_id, {r6('p')} as booking_probability, (p >= threshold)::int as predicted_booking, threshold,
  'Formula' as model_name
from (select search_id, {_FORMULA} as p from requests
      where not ({' or '.join(f'ifnull({w}, false)' for _, w in _rules())})), chosen_threshold""",
    "formula_model_info": f"""
select 'Formula' as champion_model, '{PREDICTION_POINT}' as prediction_point, threshold,
  threshold as best_f1_threshold, {len(FEATURES)} as feature_count,
  (select count(*) from labelled where split = 'train') as train_rows,
  (select count(*) from labelled where split = 'validation') as validation_rows,
  (select count(*) from labelled where split = 'test') as test_rows, '{','.join(FEATURES)}' as features,
  (select string_agg(model, ',' order by pr_auc desc, roc_auc desc) from compared) as ranking,
  (select feature from ({_IMPORTANCE}) order by importance_mean desc limit 1) as top_feature, m.*
from ({_metrics('tested_curve')}) m, chosen_threshold""",
    "lr_one_feature": """
select v.search_id, round(r, 4) + 0e0 as score
from labelled v join (select railcard_used, avg(booked_flag) as r from train group by 1) using (railcard_used)
where v.split = 'validation'""",
    "histogram_two_features": _two_feature_tree(),
    "score_violations": _violations(),
    "foreign_keys": _foreign_keys("stg_"),
    "foreign_keys_damaged": _foreign_keys("bad_"),
    "documented_metrics_all_sessions": _ALL_DOCUMENTED,
    "session_features_all_sessions": _ALL_SESSIONS,
    "imputation_values_damaged": _imputation("bad_train"),
    "one_hot_encoding": _encoded(ordinal=False),
    "ordinal_encoding": _encoded(ordinal=True),
    "gbt_one_feature": f"""
select v.search_id, round(1 / (1 + exp(-2 * (2 * r - 1))), 4) + 0e0 as score
from labelled v join (select railcard_used, avg(booked_flag) as r from train where not ({_HELD_OUT}) group by 1)
  using (railcard_used)
where v.split = 'validation'""",
}


def _with_tables(final: str) -> str:
    tables = ", ".join(f"{name} as ({text.strip()})" for name, text in TABLES.items())
    return f"with {tables} {final.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_tables(final) for name, final in FINAL.items()}
