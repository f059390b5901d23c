"""DuckDB statements equal to the registered Spark queries.

They read the same Parquet tables (views named after the tables) and round
doubles to 6 digits exactly like the Spark side, so row sets hash equally.
Shared common table expressions are composed from the fragments below.
"""

from __future__ import annotations

from hourcast.operators.elastic import MAX_SWEEPS, TOLERANCE
from hourcast.operators.tree import ELASTIC_FAMILY, GRID_BINS, GRID_DEPTHS
from hourcast.schema import FEATURE_COLUMNS, FEATURES_6, FEATURES_7, MEASURES, SUM_MEASURES

R = 6  # rounding digits, same as the Spark side


def r6_sql(expr: str) -> str:
    """39 significant bits, then half up at 6 decimals where those are coarser.

    Pure IEEE arithmetic, so Spark and DuckDB give identical doubles for
    identical inputs (their built-in round functions break ties differently).
    """
    lead = "(v * 16385e0 - (v * 16385e0 - v))"
    return (f"list_transform([({expr})::double], lambda v: case when abs{lead} < 1e12 "
            f"then floor({lead} * 1e6 + 0.5) / 1e6 else {lead} end)[1]")


def _expand_r6(sql: str) -> str:
    """Expand the ``r6(...)`` shorthand used in the statements below."""
    out, i = [], 0
    while True:
        k = sql.find("r6(", i)
        if k < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, j = 0, k + 2
        while True:
            if sql[j] == "(":
                depth += 1
            elif sql[j] == ")":
                depth -= 1
                if depth == 0:
                    break
            j += 1
        out.append(sql[i:k])
        out.append(r6_sql(_expand_r6(sql[k + 3:j])))
        i = j + 1



def rnd(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"r6({prefix}{c}) as {c}" for c in cols)


# Hourly telemetry rows from the event log (segment = user_id modulo 5, never negative).
HOURLY = """h as (
  select (((user_id % 5) + 5) % 5)::int as carrier_id, ts::date as datepart, hour(ts)::int as hour_of_day,
         avg(value) as avg_response_time, min(ts) as first_attempt, max(ts) as last_attempt,
         (count(*) filter (where event_type = 'purchase'))::double as successful_charges,
         (count(*) filter (where event_type in ('view', 'signup')))::double as no_credit,
         (count(*) filter (where event_type = 'error'))::double as errors,
         count(*)::double as total_attempts
  from events group by 1, 2, 3)"""

# + week of month (DuckDB dayofweek: Sunday = 0).
ENRICHED = HOURLY + """,
w as (select *, (floor((day(datepart) + dayofweek(date_trunc('month', datepart)::date) - 1) / 7) + 1)::double
               as week_of_month from h)"""

PROFILE = ENRICHED + """,
g as (select carrier_id, hour_of_day, week_of_month, """ + ", ".join(
    f"avg({m}) as {m}" for m in MEASURES) + """
      from w group by 1, 2, 3)"""

CUMULATIVE = PROFILE + """,
c as (select carrier_id, hour_of_day, week_of_month,
        avg(avg_response_time) over win as avg_response_time,
        sum(successful_charges) over win as successful_charges,
        sum(no_credit) over win as no_credit,
        sum(errors) over win as errors,
        sum(total_attempts) over win as total_attempts
      from g
      window win as (partition by carrier_id, week_of_month order by hour_of_day
                     rows between unbounded preceding and current row))"""

HOURLY_COLS = ["carrier_id", "datepart", "hour_of_day", "avg_response_time", "first_attempt",
               "last_attempt", "successful_charges", "no_credit", "errors", "total_attempts"]


def _hourly_select(src: str) -> str:
    return ("select carrier_id, datepart::varchar as datepart, hour_of_day, "
            "r6(avg_response_time) as avg_response_time, first_attempt::varchar as first_attempt, "
            "last_attempt::varchar as last_attempt, " + rnd(MEASURES[1:]) + f" from {src}")


SQL: dict[str, str] = {}

SQL["hourly_from_events"] = f"with {HOURLY} " + _hourly_select("h")
SQL["csv_roundtrip_hourly"] = SQL["hourly_from_events"]
SQL["csv_pipe_roundtrip"] = SQL["hourly_from_events"]
SQL["csv_drop_malformed"] = SQL["hourly_from_events"]

SQL["week_of_month"] = f"""with {ENRICHED}
select distinct datepart::varchar as datepart, week_of_month from w"""

SQL["count_by_week"] = f"""with {ENRICHED}
select week_of_month, count(*) as count from w group by 1"""

SQL["row_count"] = f"""with {HOURLY}
select count(*) as row_count from h"""

SQL["hourly_profile"] = f"""with {PROFILE}
select carrier_id, hour_of_day, week_of_month, {rnd(MEASURES)} from g"""

SQL["cumulative_profile"] = f"""with {CUMULATIVE}
select carrier_id, hour_of_day, week_of_month, {rnd(MEASURES)} from c"""

SQL["incremental_profile"] = SQL["hourly_profile"]
SQL["checkpoint_roundtrip"] = SQL["cumulative_profile"]
SQL["union_segments"] = SQL["cumulative_profile"]

HOURLY_KEYS_ORDER = "carrier_id, datepart, hour_of_day"

SQL["preview_first_rows"] = f"with {HOURLY} " + _hourly_select(
    f"(select * from h order by {HOURLY_KEYS_ORDER} limit 5)")

SQL["first_match_row"] = f"with {HOURLY} " + _hourly_select(
    "(select * from h where carrier_id = 1 and errors > 0 order by datepart, hour_of_day limit 1)")

SQL["project_measures"] = f"with {HOURLY} select carrier_id, hour_of_day, {rnd(MEASURES)} from h"

SQL["segment_filter"] = f"""with {CUMULATIVE}
select carrier_id, hour_of_day, week_of_month, {rnd(MEASURES)} from c where carrier_id = 1"""

SQL["point_filter_raw"] = f"""with {ENRICHED}
select carrier_id, datepart::varchar as datepart, hour_of_day, week_of_month, {rnd(MEASURES)} from w
where carrier_id = 2 and hour_of_day = 11 and week_of_month = 3"""

SQL["point_filter_profile"] = f"""with {PROFILE}
select carrier_id, hour_of_day, week_of_month, {rnd(MEASURES)} from g
where carrier_id = 2 and hour_of_day = 11 and week_of_month = 3"""

# ---------------------------------------------------------------- features, labels, split, scaler

F7, F6, F8 = FEATURES_7, FEATURES_6, FEATURE_COLUMNS

FEATURES = ENRICHED + """,
f as (select carrier_id as segment, concat_ws('|', carrier_id, datepart, hour_of_day) as row_key, """ + ", ".join(
    f"{c}::double as {c}" for c in F8) + """ from w)"""

LABELED = FEATURES + """,
lz as (select *, case when successful_charges = 0 then 0.0 when successful_charges > 0 then ln(successful_charges) end
              as label from f),
l as (select segment, row_key, label, successful_charges as raw_label, """ + ", ".join(F7) + """
      from lz where label is not null),
lb as (select *, (('0x' || substr(md5(row_key), 1, 8))::bigint % 100) < 70 as is_train from l),
tr as (select * from lb where is_train),
te as (select * from lb where not is_train),
st as (select """ + ", ".join(f"stddev_samp({c}) as std_{c}" for c in F7) + """ from tr)"""


def _scaled(src: str) -> str:
    cols = ", ".join(f"case when coalesce(std_{c}, 0.0) = 0.0 then 0.0 else {c} / std_{c} end as {c}" for c in F7)
    return f"select segment, row_key, label, raw_label, {cols} from {src} cross join st"


SCALED = LABELED + f""",
trs as ({_scaled('tr')}),
tes as ({_scaled('te')})"""

XS = F7 + ["1.0::double"]


def _x(i: int) -> str:
    return XS[i]


MOMENT_COLS = ["n"] + [f"g{i}_{j}" for i in range(8) for j in range(i, 8)] + [f"b{i}" for i in range(8)]

MOMENTS = SCALED + """,
mo as (select segment, count(*)::double as n, """ + ", ".join(
    f"sum({_x(i)} * {_x(j)}) as g{i}_{j}" for i in range(8) for j in range(i, 8)) + ", " + ", ".join(
    f"sum({_x(i)} * label) as b{i}" for i in range(8)) + """ from trs group by segment)"""


def _g(i, j):
    return f"g{min(i, j)}_{max(i, j)}"


_G_LIST = "[" + ", ".join("[" + ", ".join(_g(i, j) for j in range(8)) + "]" for i in range(8)) + "]"
_B_LIST = "[" + ", ".join(f"b{i}" for i in range(8)) + "]"
_STEP = "(0.1 / sqrt(gd.i + 1))"
_GRAD = "(list_dot_product(z[2], gd.w) - z[3]) / mm.n"
_ZIP = "list_zip(gd.w, mm.g, mm.b)"

# Gradient descent of all three model kinds as one recursive CTE over the moments.
GD = MOMENTS + f""",
mm as (select segment, n, {_G_LIST} as g, {_B_LIST} as b from mo),
kinds as (select * from (values ('linear'), ('ridge'), ('lasso')) t(model)),
gd as (
  select model, segment, 0 as i, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]::double[] as w, false as done
  from mm cross join kinds
  union all
  select model, segment, i + 1 as i, nw as w,
         (i + 1 > 1 and sqrt(list_sum(list_transform(list_zip(nw, w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))
            < 0.001 * greatest(sqrt(list_sum(list_transform(nw, lambda z: z * z))), 1.0)) as done
  from (
    select gd.model, gd.segment, gd.i, gd.w,
      case gd.model
        when 'linear' then list_transform({_ZIP}, lambda z: z[1] - {_STEP} * {_GRAD})
        when 'ridge' then list_transform({_ZIP}, lambda z: z[1] * (1.0 - {_STEP} * 0.01) - {_STEP} * {_GRAD})
        else list_transform(list_transform({_ZIP}, lambda z: z[1] - {_STEP} * {_GRAD}),
                            lambda v: sign(v) * greatest(abs(v) - {_STEP} * 0.01, 0.0))
      end as nw
    from gd join mm using (segment)
    where not gd.done and gd.i < 100) t
),
coefs as (select model, segment, max(i)::int as iterations, arg_max(w, i) as w from gd group by model, segment),
pred as (select c.model, t.segment, t.row_key, t.label, t.raw_label,
                c.w[8] + list_dot_product(c.w[1:7], [{', '.join('t.' + c for c in F7)}]) as prediction
         from tes t join coefs c using (segment))"""

SQL["log_label_null"] = f"""with {FEATURES}
select segment, row_key, r6(successful_charges) as successful_charges,
       r6(case when successful_charges > 0 then ln(successful_charges) end) as label from f"""

SQL["log_label_zero_guard"] = f"""with {FEATURES}
select segment, row_key, r6(successful_charges) as successful_charges,
       r6(case when successful_charges = 0 then 0.0
                  when successful_charges > 0 then ln(successful_charges) end) as label from f"""

SQL["label_not_null"] = f"""with {FEATURES}
select segment, row_key, r6(ln(successful_charges)) as label from f where successful_charges > 0"""

SQL["drop_label_project"] = f"with {FEATURES} select row_key, {rnd(F7)} from f"

def vec_text(items: list[str]) -> str:
    """Same text as the Spark side: [v1,...] with every (rounded) value as %.6f."""
    return "'[' || array_to_string(list_transform([" + ", ".join(items) + "], lambda v: printf('%.6f', v)), ',') || ']'"


SQL["labeled_features"] = f"""with {LABELED}
select row_key, r6(label) as label, {vec_text([f'r6({c})' for c in F7])} as features from l"""

SQL["assemble_features"] = f"""with {ENRICHED}
select concat_ws('|', carrier_id, datepart, hour_of_day) as row_key,
       {vec_text([f'r6({c}::double)' for c in F6])} as features_success from w"""

SQL["hash_split"] = f"""with {FEATURES}
select (('0x' || substr(md5(row_key), 1, 8))::bigint % 100) < 70 as is_train, count(*) as n_rows
from f group by 1"""

SQL["hash_split_ratios"] = f"""with {FEATURES},
b as (select ('0x' || substr(md5(row_key), 1, 8))::bigint % 100 as bucket from f)
select p as train_pct, count(*) filter (where bucket < p) as n_train, count(*) filter (where bucket >= p) as n_test
from b cross join (values (70), (80), (90)) t(p) group by p"""

SQL["random_split_cover"] = f"""with {FEATURES}
select count(*) as n_rows, count(distinct row_key) as n_keys, 0::bigint as n_overlap from f"""

SQL["scaler_stats"] = f"with {LABELED} select {rnd(['std_' + c for c in F7])} from st"

SQL["scaler_apply"] = f"with {SCALED} select segment, row_key, {rnd(F7)} from tes"

SQL["moments_per_segment"] = f"with {MOMENTS} select segment, {rnd(MOMENT_COLS)} from mo"


def _coefs_wide(kind: str) -> str:
    ws = ", ".join(f"r6(w[{i + 1}]) as w_{c}" for i, c in enumerate(F7))
    return f"""with recursive {GD}
select model, segment, iterations, r6(w[8]) as intercept, {ws} from coefs where model = '{kind}'"""


SQL["linear_gd_coefs"] = _coefs_wide("linear")
SQL["ridge_gd_coefs"] = _coefs_wide("ridge")
SQL["lasso_gd_coefs"] = _coefs_wide("lasso")

SQL["linear_coefs_long"] = f"""with recursive {GD}
select model, segment, feature, r6(weight) as weight from (
  select model, segment, unnest([{', '.join(repr(c) for c in F7)}, 'intercept']) as feature,
         unnest(w) as weight from coefs) u"""

SQL["linear_score_join"] = f"""with recursive {GD}
select model, segment, row_key, r6(label) as label, r6(prediction) as prediction from pred"""

SQL["bucketed_score_join"] = SQL["linear_score_join"]

_ONE = "case when (exp(label) - exp(prediction)) / exp(label) > 0.35 then 0.0 else 1.0 end"
_TWO = ("case when exp(label) = 0 then (case when exp(prediction) = 0 then 1.0 else 0.0 end) "
        "when abs((exp(label) - exp(prediction)) / exp(label)) < 0.15 then 1.0 else 0.0 end")
_SQ = "(label - prediction) * (label - prediction)"
_MREL = "avg(case when prediction <> 0 then abs(label - prediction) / prediction end)"

SQL["metrics_log_space"] = f"""with recursive {GD}
select model, count(*) as n, r6(avg({_SQ})) as mse, r6(sqrt(avg({_SQ}))) as rmse,
       r6({_MREL}) as mean_rel_error, r6(avg({_ONE})) as accuracy_one_sided
from pred group by model"""

SQL["metrics_per_segment"] = f"""with recursive {GD}
select model, segment, count(*) as n, r6(avg({_SQ})) as mse, r6(sqrt(avg({_SQ}))) as rmse,
       r6(avg(abs(label - prediction))) as mae, r6({_MREL}) as mean_rel_error,
       r6(1.0 - sum({_SQ}) / nullif(var_pop(label) * count(*), 0)) as r2,
       r6(avg({_ONE})) as accuracy_one_sided, r6(avg({_TWO})) as accuracy_two_sided
from pred group by model, segment"""

SQL["metrics_r2"] = f"""with recursive {GD}
select model, count(*) as n, r6(1.0 - sum({_SQ}) / nullif(var_pop(label) * count(*), 0)) as r2
from pred group by model"""

SQL["accuracy_one_sided"] = f"""with recursive {GD}
select model, r6(avg({_ONE})) as accuracy_one_sided from pred group by model"""

def _pct(t: float) -> str:
    return f"r6(avg(case when (exp(label) - exp(prediction)) / exp(label) > {t} then 0.0 else 1.0 end) * 100.0)"


SQL["accuracy_thresholds"] = f"""with recursive {GD}
select model, segment, {_pct(0.1)} as pct_at_01, {_pct(0.2)} as pct_at_02 from pred group by model, segment"""

SQL["accuracy_curve"] = f"""with recursive {GD}
select model, segment, r6(threshold) as threshold,
       r6(avg(case when (exp(label) - exp(prediction)) / exp(label) > threshold then 0.0 else 1.0 end)) as accuracy_one_sided
from pred cross join (select unnest([0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35])::double as threshold) group by model, segment, threshold"""

SQL["accuracy_two_sided"] = f"""with recursive {GD}
select model, r6(avg({_TWO})) as accuracy_two_sided from pred group by model"""

ALERTS = GD + """,
sc as (select segment, row_key, floor(raw_label)::bigint as measured,
              floor(r6(exp(prediction)))::bigint as predicted from pred where model = 'linear'),
se as (select *, case when measured <> 0 then (predicted - measured)::double / measured * 100.0 end as error_pct
       from sc),
al as (select segment, row_key, measured, predicted, error_pct,
              concat('[ALERT] segment ', segment, ' hour ', row_key, ': measured ', measured,
                     ', predicted ', predicted, ', error ',
                     case when measured = 0 then 'outage' else concat(floor(error_pct + 0.5)::bigint, '%') end) as message
       from se where coalesce(error_pct > 45.0, false) or (measured = 0 and predicted > 0))"""

SQL["score_alerts"] = f"""with recursive {ALERTS}
select segment, row_key, measured, predicted, r6(error_pct) as error_pct, message from al"""

SQL["outage_alerts"] = f"""with recursive {ALERTS}
select segment, row_key, measured, predicted, message from al where measured = 0"""

SQL["alert_message"] = f"with recursive {ALERTS} select row_key, message from al"

# ---------------------------------------------------------------- trees

SQL["tree_fit_check"] = f"""with {LABELED}
select segment, count(*) as n_rows, r6(sum(label)) as sum_label, r6(sum(label)) as sum_prediction, 0::bigint as n_off
from tr group by segment"""

# Best single split on hour or week: thresholds are midpoints of neighbouring values, the split
# with the largest drop of the squared error wins, the first feature and threshold on ties.
STUMP = """,
v as (select segment, label, 0 as f, 'hour_of_day' as name, hour_of_day as x from tr
      union all select segment, label, 1, 'week_of_month', week_of_month from tr),
cut as (select segment, f, name, (x + lead(x) over (partition by segment, f order by x)) / 2 as t
        from (select distinct segment, f, name, x from v) u),
sides as (select c.segment, c.f, c.name, c.t,
                 avg(label) filter (where x <= t) as low, avg(label) filter (where x > t) as high,
                 coalesce(var_pop(label) filter (where x <= t), 0) * count(*) filter (where x <= t)
                 + coalesce(var_pop(label) filter (where x > t), 0) * count(*) filter (where x > t) as err
          from cut c join v on v.segment = c.segment and v.f = c.f where t is not null group by all),
best as (select * from (select *, row_number() over (partition by segment order by err, f, t) as nth from sides) u
         where nth = 1)"""

# Splits whose drops agree to 1e-9 of the segment's squared error are ties; a segment without a drop has one leaf.
SQL["tree_stump"] = f"""with {LABELED}{STUMP},
whole as (select segment, avg(label) as mean, var_pop(label) * count(*) as total,
                 stddev_pop(label) > 1e-9 * greatest(abs(avg(label)), 1) as spread
          from tr where segment is not null group by segment),
units as (select s.*, floor((total - err) / total / 1e-9 + 0.5) as units from sides s join whole using (segment) where spread),
stump as (select * from (select *, row_number() over (partition by segment order by units desc, f, t) as nth
                         from units where units >= 1) u where nth = 1)
select segment, name || ' <= ' || t::varchar as conditions, r6(low) as prediction,
       2::bigint as n_leaves, r6(err) as squared_error from stump
union all
select segment, name || ' > ' || t::varchar, r6(high), 2::bigint, r6(err) from stump
union all
select segment, '', r6(mean), 1::bigint, r6(total) from whole where segment not in (select segment from stump)"""


def _two_digits(c: str) -> str:
    """The leading 39 bits, half up at 2 decimals: one rounding, as on the Spark side."""
    return f"floor(({c} * 16385e0 - ({c} * 16385e0 - {c})) * 100.0 + 0.5) / 100.0"


# Days (segment x date, hour 0), scored by the best single split of their segment.
DAILY = ENRICHED + """,
d as (select carrier_id, datepart, week_of_month, 0 as hour_of_day,
             sum(avg_response_time * total_attempts) / sum(total_attempts) as avg_response_time, """ + ", ".join(
    f"sum({m}) as {m}" for m in SUM_MEASURES) + """ from w group by 1, 2, 3)"""
DAY_LABELED = DAILY + LABELED.removeprefix(ENRICHED).replace("from w)", "from d)")
_TEXT = " || ', ' || ".join(f"'{c}=' || printf('%.2f', {_two_digits(c)})" for c in F7)
DAY_ALERTS = DAY_LABELED + STUMP + f""",
dp as (select segment, row_key, raw_label, {_TEXT} as text,
              case when t is null then (select avg(label) from tr where tr.segment = te.segment)
                   when (case f when 0 then hour_of_day else week_of_month end) <= t then low else high end as prediction
       from te left join best using (segment)),
ds as (select *, floor(raw_label)::bigint as measured, floor(r6(exp(prediction)))::bigint as predicted from dp),
de as (select *, case when measured <> 0 then (predicted - measured)::double / measured * 100.0 end as error_pct from ds),
da as (select *, coalesce(error_pct > 45.0, false) or (measured = 0 and predicted > 0) as is_alert from de)"""

SQL["score_days"] = f"""with {DAY_ALERTS}
select segment, row_key, measured, predicted, r6(error_pct) as error_pct, is_alert from da"""

SQL["day_alerts"] = f"""with {DAY_ALERTS}
select segment, row_key, measured, predicted, r6(error_pct) as error_pct,
       concat('[ALERT] segment ', segment, ' hour ', row_key, ': measured ', measured, ', predicted ', predicted,
              ', error ', case when measured = 0 then 'outage' else concat(floor(error_pct + 0.5)::bigint, '%') end,
              ' (', text, ')') as message
from da where is_alert"""

SQL["grid_search_candidates"] = f"""with {CUMULATIVE},
p as (select carrier_id as segment, ('0x' || substr(md5(concat_ws('|', carrier_id, week_of_month, hour_of_day)), 1, 8))::bigint
             % 100 as bucket from c where successful_charges > 0),
n as (select segment, count(*) filter (where bucket >= 80) as n_validation from p group by 1)
select segment, max_depth, max_bins, n_validation, 1::bigint as n_winners
from n cross join (select unnest({GRID_DEPTHS}) as max_depth) cross join (select unnest({GRID_BINS}) as max_bins)
where n_validation > 0"""

# ---------------------------------------------------------------- trees of any depth

def tree_ctes(p: str, src: str, features: list[str], depth: int, bins: list[int]) -> str:
    """Trees grown level by level, as common table expressions whose names begin with ``p``.

    ``src`` has segment, row_key, label, is_fit and the features.  {p}r<d> has the node (root 1,
    children 2i and 2i + 1) that every row reaches after d splits, per bins value b, and {p}m<d>
    the mean label of the fit rows of each of these nodes.
    """
    long = " union all ".join(f"select segment, row_key, is_fit, {i} as f, {c}::double as x from {src}" for i, c in enumerate(features))
    t = f"""{p}tot as materialized (select segment, avg(label) as centre, sqrt(var_pop(label) * count(*)) as scale
                            from {src} where is_fit group by 1),
{p}long as materialized ({long}),
{p}val as materialized (select *, row_number() over (partition by segment, f order by x) as i, count(*) over (partition by segment, f) as m,
                        sum(n) over (partition by segment, f) as total, lag(x) over (partition by segment, f order by x) as before
                 from (select segment, f, x, count(*) as n from {p}long where is_fit group by 1, 2, 3) u),
{p}all as materialized (select v.*, b, least(b, total) - 1 as n_splits from {p}val v cross join (select unnest({bins}) as b)),
{p}walk as (select segment, f, b, i, n::bigint as seen, (total / (n_splits + 1))::double as target, (total / (n_splits + 1))::double as stride, null::double as t
           from {p}all where i = 1 and m - 1 > n_splits
           union all
           select w.segment, w.f, w.b, v.i, w.seen + v.n,
                  case when abs(w.seen - w.target) < abs(w.seen + v.n - w.target) then w.target + w.stride else w.target end, w.stride,
                  case when abs(w.seen - w.target) < abs(w.seen + v.n - w.target) then (v.before + v.x) / 2 end
           from {p}walk w join {p}val v on v.segment = w.segment and v.f = w.f and v.i = w.i + 1),
{p}cuts as materialized (select segment, f, b, (before + x) / 2 as t from {p}all where m - 1 <= n_splits and i > 1
           union all select segment, f, b, t from {p}walk where t is not null),
{p}cell as materialized (select l.segment, l.row_key, k.b, l.f, count(c.t) as cell
           from {p}long l cross join (select unnest({bins}) as b) k
           left join {p}cuts c on c.segment = l.segment and c.f = l.f and c.b = k.b and c.t < l.x group by all),
{p}r0 as materialized (select s.segment, s.row_key, s.is_fit, s.label, b, 1::bigint as node,
                       case when scale > 0 then (s.label - centre) / scale else 0.0 end as y
           from {src} s join {p}tot using (segment) cross join (select unnest({bins}) as b))"""
    sse = lambda n, s, q: f"(({q}) - ({s}) * ({s}) / ({n}))"
    fall = f"{sse('tn', 'ts', 'tq')} - {sse('ln', 'ls', 'lq')} - {sse('tn - ln', 'ts - ls', 'tq - lq')}"
    for d in range(depth):
        t += f""",
{p}h{d} as (select segment, b, node, f, cell, count(*) as n, sum(y) as s, sum(y * y) as q
           from {p}r{d} join {p}cell using (segment, row_key, b) where is_fit and node >= {1 << d} group by all),
{p}c{d} as (select *, sum(n) over w as ln, sum(s) over w as ls, sum(q) over w as lq, sum(n) over a as tn, sum(s) over a as ts, sum(q) over a as tq
           from {p}h{d} window a as (partition by segment, b, node, f),
                               w as (partition by segment, b, node, f order by cell rows between unbounded preceding and current row)),
{p}u{d} as (select *, floor(({fall}) * 1e9 + 0.5) as units from {p}c{d} where ln < tn),
{p}b{d} as materialized (select segment, b, node, f as bf, cell as bc from {p}u{d} where units >= 1
           qualify row_number() over (partition by segment, b, node order by units desc, f, cell) = 1),
{p}r{d + 1} as materialized (select r.segment, r.row_key, r.is_fit, r.label, r.b,
                  case when bf is null then node else node * 2 + (cell > bc)::int end as node, r.y
           from {p}r{d} r left join {p}b{d} using (segment, b, node)
           left join {p}cell c on c.segment = r.segment and c.row_key = r.row_key and c.b = r.b and c.f = bf)"""
    for d in range(depth + 1):
        t += f""",
{p}m{d} as (select segment, b, node, any_value(centre) + any_value(scale) * sum(y) / count(*) as prediction
           from {p}r{d} join {p}tot using (segment) where is_fit group by all)"""
    return t


POOLED = "recursive " + LABELED + """,
ts as (select *, is_train as is_fit from lb),
""" + tree_ctes("t", "ts", F7, 7, [32]) + """,
tp as (select segment, row_key, label, is_fit, prediction from tr7 join tm7 using (segment, b, node))"""

SQL["pooled_tree_scores"] = f"""with {POOLED}
select segment, row_key, r6(label) as label, r6(prediction) as prediction from tp where not is_fit"""

SQL["feature_file_alerts"] = f"""with {POOLED},
fa as (select tp.segment, concat_ws('|', printf('%.1f', f.carrier_id), printf('%.1f', f.week_of_month), printf('%.1f', f.hour_of_day)) as row_key,
              floor(f.successful_charges)::bigint as measured, floor(r6(exp(prediction)))::bigint as predicted, {_TEXT} as text
       from tp join f using (segment, row_key)),
fe as (select *, case when measured <> 0 then (predicted - measured)::double / measured * 100.0 end as error_pct from fa)
select segment, row_key, measured, predicted, r6(error_pct) as error_pct,
       concat('[ALERT] segment ', segment, ' hour ', row_key, ': measured ', measured, ', predicted ', predicted,
              ', error ', case when measured = 0 then 'outage' else concat(floor(error_pct + 0.5)::bigint, '%') end,
              ' (', text, ')') as message
from fe where coalesce(error_pct > 45.0, false) or (measured = 0 and predicted > 0)"""

# Labelled rows of the running profile.
PROFILE_ROWS = CUMULATIVE + """,
pr as (select carrier_id as segment, concat_ws('|', carrier_id, week_of_month, hour_of_day) as row_key, ln(successful_charges) as label,
              """ + ", ".join(f"{c}::double as {c}" for c in F6) + """,
              ('0x' || substr(md5(concat_ws('|', carrier_id, week_of_month, hour_of_day)), 1, 8))::bigint % 100 as bucket
       from c where successful_charges > 0)"""


def grid_ctes(p: str, src: str) -> str:
    """The grid's report over the trees ``p``: {p}rep."""
    scored = " union all ".join(
        f"select segment, {d} as max_depth, b as max_bins, label, prediction from {p}r{d} join {p}m{d} using (segment, b, node) where not is_fit"
        for d in GRID_DEPTHS)
    return tree_ctes(p, src, F6, max(GRID_DEPTHS), GRID_BINS) + f""",
{p}rmse as (select segment, max_depth, max_bins, count(*) as n_validation, sqrt(avg((label - prediction) * (label - prediction))) as validation_rmse
            from ({scored}) u group by all),
{p}rep as materialized (select *, row_number() over (partition by segment order by floor(validation_rmse * 1e9 + 0.5), max_depth, max_bins) = 1 as is_best
            from {p}rmse)"""


SQL["grid_search_report"] = f"""with recursive {PROFILE_ROWS},
gs as (select *, bucket < 80 as is_fit from pr),
{grid_ctes('g', 'gs')}
select segment, max_depth, max_bins, n_validation, r6(validation_rmse) as validation_rmse, is_best from grep"""

_BEST_ROWS = " union all ".join(
    f"select segment, label, prediction, is_fit, {d} as max_depth, b as max_bins from fr{d} join fm{d} using (segment, b, node)" for d in GRID_DEPTHS)
_BEST_NODES = " union all ".join(
    f"select segment, b as max_bins, {d} as level, count(distinct node) as n from fr{d} where is_fit and node >= {1 << d} group by all" for d in range(max(GRID_DEPTHS) + 1))
_ONE_AT = "case when (exp(label) - exp(prediction)) / exp(label) > 0.1 then 0.0 else 1.0 end"
SQL["train_segments_report"] = f"""with recursive {PROFILE_ROWS},
gs as (select *, bucket < 80 as is_fit from pr where bucket < 90),
{grid_ctes('g', 'gs')},
fs as (select *, bucket < 90 as is_fit from pr),
{tree_ctes('f', 'fs', F6, max(GRID_DEPTHS), GRID_BINS)},
bw as (select segment, max_depth, max_bins from grep where is_best),
k as (select segment, max_depth, max_bins, sum(n)::int as num_nodes from bw join ({_BEST_NODES}) u using (segment, max_bins) where level <= max_depth group by all),
e as (select segment, count(*) as n, avg({_SQ}) as mse, sqrt(avg({_SQ})) as rmse, avg(abs(label - prediction)) as mae, {_MREL} as mean_rel_error,
             1.0 - sum({_SQ}) / nullif(var_pop(label) * count(*), 0) as r2, avg({_ONE_AT}) as one, avg({_TWO}) as two
      from bw join ({_BEST_ROWS}) u using (segment, max_depth, max_bins) where not is_fit group by segment)
select segment, max_depth, max_bins, num_nodes, n, r6(mse) as mse, r6(rmse) as rmse, r6(mae) as mae, r6(mean_rel_error) as mean_rel_error,
       r6(r2) as r2, r6(one) as accuracy_one_sided, r6(two) as accuracy_two_sided
from k left join e using (segment)"""

# ---------------------------------------------------------------- elastic net

_D6 = range(len(F6))


def _weight(j: int) -> str:
    """The new weight of coordinate j in a sweep, given the names of the others' current values."""
    others = " - ".join(f"em.r{min(i, j)}_{max(i, j)} * {'n' if i < j else 'w'}{i}" for i in _D6 if i != j)
    rest = f"(em.c{j} - {others})"
    return (f"case when em.r{j}_{j} > 0 then sign({rest}) * greatest(abs({rest}) - em.lasso, 0.0) / (em.r{j}_{j} + em.ridge) else 0.0 end")


def _sweep() -> str:
    """One sweep: a chain of subqueries, one for each coordinate."""
    inner = "select e.model, e.segment, e.i, " + ", ".join(f"e.w{i}" for i in _D6) + " from ed e where not e.done and e.i < " + str(MAX_SWEEPS)
    for j in _D6:
        inner = f"select s.*, {_weight(j)} as n{j} from ({inner}) s join em using (model, segment)"
    moved = ", ".join(f"abs(n{i} - w{i})" for i in _D6)
    return f"select model, segment, i + 1, {', '.join(f'n{i}' for i in _D6)}, greatest({moved}) < {TOLERANCE} from ({inner}) t"


_SPREAD = {i: f"sqrt(covar_pop({F6[i]}, {F6[i]}))" for i in _D6}
ELASTIC = "recursive " + PROFILE_ROWS + """,
et as (select * from pr where bucket < 80),
eu as (select segment, count(*) as n, avg(label) as label_mean, var_pop(label) as label_var, """ + ", ".join(
    [f"avg({F6[i]}) as m{i}, covar_pop({F6[i]}, label) as k{i}" for i in _D6]
    + [f"covar_pop({F6[i]}, {F6[j]}) as v{i}_{j}" for i in _D6 for j in range(i, len(F6))]) + """ from et group by segment),
ei as (select *, sqrt(label_var) as ystd, case when label_var > 0 then 1 / sqrt(label_var) else 0.0 end as yi, """ + ", ".join(
    f"case when v{i}_{i} > 0 then 1 / sqrt(v{i}_{i}) else 0.0 end as i{i}" for i in _D6) + """ from eu),
em as materialized (select model, segment, n, label_mean, label_var, ystd, reg, alpha, reg * yi * alpha as lasso, reg * yi * (1.0 - alpha) as ridge, """ + ", ".join(
    [f"i{i}, m{i}, k{i} * i{i} * yi as c{i}" for i in _D6] + [f"v{i}_{j} * i{j} * i{i} as r{i}_{j}" for i in _D6 for j in range(i, len(F6))]) + """
      from ei cross join (values """ + ", ".join(f"('{name}', {float(reg)}::double, {float(alpha)}::double)" for name, reg, alpha, _ in ELASTIC_FAMILY) + """) k(model, reg, alpha)),
ed as (select model, segment, 0 as i, """ + ", ".join(f"0.0::double as w{i}" for i in _D6) + f""", false as done from em
       union all {_sweep()}),
ew as (select model, segment, {', '.join(f'arg_max(w{i}, i) as w{i}' for i in _D6)} from ed group by 1, 2),
ec as (select em.*, {', '.join(f'w{i}, w{i} * i{i} * ystd as b{i}' for i in _D6)} from em join ew using (model, segment)),
ee as (select *, label_mean - ({' + '.join(f'b{i} * m{i}' for i in _D6)}) as intercept,
              greatest(1.0 - 2.0 * ({' + '.join(f'w{i} * c{i}' for i in _D6)}) + ({' + '.join(f'w{i} * w{j} * r{min(i, j)}_{max(i, j)}' for i in _D6 for j in _D6)}), 0.0) * label_var as mse
       from ec)"""

SQL["elastic_family_rmse"] = f"""with {ELASTIC}
select segment, model, r6(reg) as reg_param, r6(alpha) as elastic_net_param, n as num_instances, r6(sqrt(mse)) as rmse,
       r6(1.0 - mse / nullif(label_var, 0)) as r2 from ee"""

SQL["elastic_coefs"] = f"""with {ELASTIC}
select model, segment, feature, r6(weight) as weight from (
  select model, segment, unnest([{', '.join(repr(c) for c in F6)}, 'intercept']) as feature,
         unnest([{', '.join(f'b{i}' for i in _D6)}, intercept]) as weight from ee) u"""

SQL["elastic_score_join"] = f"""with {ELASTIC}
select model, pr.segment, row_key, r6(label) as label, r6(intercept + {' + '.join(f'b{i} * {F6[i]}' for i in _D6)}) as prediction
from pr join ee on ee.segment = pr.segment where bucket >= 80"""

SQL["feature_vector_scan"] = f"with {FEATURES} select {rnd(F8)} from f"
SQL["feature_parquet_scan"] = SQL["feature_vector_scan"]
SQL["stream_hourly_replay"] = SQL["hourly_from_events"]

# ---------------------------------------------------------------- silent hours

_HOUR = "datepart::timestamp + hour_of_day * interval 1 hour"
EXPECTED = f"""xb as (select min({_HOUR}) as a, max({_HOUR}) as b from h),
xs as (select carrier_id, t::date as datepart, hour(t)::int as hour_of_day
       from (select distinct carrier_id from h) s cross join (select unnest(generate_series(a, b, interval 1 hour)) as t from xb))"""

SQL["completed_hours"] = f"""with {HOURLY},
{EXPECTED}
select carrier_id, datepart::varchar as datepart, hour_of_day, r6(avg_response_time) as avg_response_time, """ + ", ".join(
    f"r6(coalesce({m}, 0.0)) as {m}" for m in SUM_MEASURES) + """, total_attempts is null as is_silent
from xs left join h using (carrier_id, datepart, hour_of_day)"""

_USUAL = [m for m in MEASURES if m != "successful_charges"]
# Silent hours with the profile's means as features, scaled and scored like the others.
SILENT = GD + f""",
{EXPECTED},
xw as (select *, (floor((day(datepart) + dayofweek(date_trunc('month', datepart)::date) - 1) / 7) + 1)::double as week_of_month
       from xs anti join h using (carrier_id, datepart, hour_of_day)),
xg as (select carrier_id, hour_of_day, week_of_month, {', '.join(f'avg({m}) as {m}' for m in _USUAL)} from w group by 1, 2, 3),
xh as (select carrier_id, hour_of_day, {', '.join(f'avg({m}) as {m}' for m in _USUAL)} from xg group by 1, 2),
xf as (select xw.carrier_id as segment, concat_ws('|', xw.carrier_id, xw.datepart, xw.hour_of_day) as row_key, 0.0 as label, 0.0 as raw_label,
              {_HOUR.replace('datepart', 'xw.datepart').replace('hour_of_day', 'xw.hour_of_day')} as starts,
              xw.carrier_id::double as carrier_id, xw.hour_of_day::double as hour_of_day, xw.week_of_month,
              {', '.join(f'coalesce(xg.{m}, xh.{m}) as {m}' for m in _USUAL)}
       from xw left join xg on xg.carrier_id = xw.carrier_id and xg.hour_of_day = xw.hour_of_day and xg.week_of_month = xw.week_of_month
       left join xh on xh.carrier_id = xw.carrier_id and xh.hour_of_day = xw.hour_of_day),
xc as ({_scaled('xf')}),
xp as (select t.segment, t.row_key, 0::bigint as measured, floor(r6(exp(c.w[8] + list_dot_product(c.w[1:7], [{', '.join('t.' + c for c in F7)}]))))::bigint as predicted
       from xc t left join coefs c on c.segment = t.segment and c.model = 'linear'
       where {' and '.join(f't.{c} is not null' for c in F7)}
       union all select segment, row_key, 0, null from xf where {' or '.join(f'{c} is null' for c in F7)})"""

SQL["silent_hour_scores"] = f"""with recursive {SILENT}
select segment, row_key, measured, predicted, null::double as error_pct, coalesce(predicted > 0, false) as is_alert from xp"""

# Gaps and islands: hours minus their rank are equal within an incident.
SQL["incidents"] = f"""with recursive {SILENT}{ALERTS.removeprefix(GD)},
ih as (select segment, split_part(row_key, '|', 2)::timestamp + split_part(row_key, '|', 3)::int * interval 1 hour as t, measured, predicted
       from (select segment, row_key, measured, predicted from al union all select segment, row_key, measured, predicted from xp where predicted > 0) u),
ii as (select *, t - row_number() over (partition by segment order by t) * interval 1 hour as island from ih)
select segment, min(t)::varchar as started, (max(t) + interval 1 hour)::varchar as ended, count(*) as n_hours, sum(measured)::bigint as measured,
       sum(predicted)::bigint as predicted, (sum(predicted) - sum(measured))::bigint as lost, count(*) filter (where measured = 0) as n_silent
from ii group by segment, island"""

SQL["stream_silent_replay"] = f"""with recursive {SILENT}
select segment, row_key, measured, predicted,
       concat('[ALERT] segment ', segment, ' hour ', row_key, ': measured 0, predicted ', predicted, ', error outage') as message
from xp join xf using (segment, row_key)
where predicted > 0 and starts + interval 1 hour <= (select max(ts) from events) - interval 1 hour"""

SQL["stream_once_replay"] = SQL["hourly_from_events"]

SQL = {k: _expand_r6(v) for k, v in SQL.items()}

# Streaming alerts: every hour whose window the final watermark (max event time
# - 1 hour) has closed, scored with the batch-trained linear model.
_SL_COLS = ", ".join(f"{c}::double as {c}" for c in F7)
STREAM_ALERTS = GD + f""",
sl as (select * from (
         select carrier_id as segment, concat_ws('|', carrier_id, datepart, hour_of_day) as row_key,
                case when successful_charges = 0 then 0.0 when successful_charges > 0 then ln(successful_charges) end
                  as label,
                successful_charges as raw_label, {_SL_COLS}
         from w
         where datepart::timestamp + (hour_of_day + 1) * interval 1 hour
               <= (select max(ts) from events) - interval 1 hour) x
       where label is not null),
sls as ({_scaled('sl')}),
spred as (select t.segment, t.row_key, t.raw_label,
                 c.w[8] + list_dot_product(c.w[1:7], [{', '.join('t.' + c for c in F7)}]) as prediction
          from sls t join coefs c on c.segment = t.segment and c.model = 'linear'),
ssc as (select segment, row_key, floor(raw_label)::bigint as measured,
               floor(r6(exp(prediction)))::bigint as predicted from spred),
sse as (select *, case when measured <> 0 then (predicted - measured)::double / measured * 100.0 end as error_pct
        from ssc),
sal as (select segment, row_key, measured, predicted, error_pct,
               concat('[ALERT] segment ', segment, ' hour ', row_key, ': measured ', measured,
                      ', predicted ', predicted, ', error ',
                      case when measured = 0 then 'outage' else concat(floor(error_pct + 0.5)::bigint, '%') end) as message
        from sse where coalesce(error_pct > 45.0, false) or (measured = 0 and predicted > 0))"""

SQL["stream_alerts_replay"] = _expand_r6(f"""with recursive {STREAM_ALERTS}
select segment, row_key, measured, predicted, r6(error_pct) as error_pct, message from sal""")
