"""ANSI SQL (DuckDB dialect) for the registered queries, over the same tables.

The SQL computes typed values straight from the tables. It never builds or parses the JSON and
CSV texts that the Spark queries go through.
"""

from __future__ import annotations

from checks.queries import (
    BRIEFING_DAY,
    EXISTING_BEFORE,
    LUNAR_LIMIT,
    NOW,
    PIPELINES,
    SATELLITES_BEFORE,
)
from skyledger.operators.quality import Check
from skyledger.plans.checks import JOB_GATES, TABLE_TESTS

_EXISTING = f"date '{EXISTING_BEFORE}'"
_NOW = f"timestamp '{NOW}'"
_PIPELINES = ", ".join(f"'{p}'" for p in PIPELINES)


def _number(text: str) -> str:
    """Double of a decimal, read from its text as the engine under test does."""
    return f"cast(cast({text} as varchar) as double)"


def _round(value: str, digits: int) -> str:
    """Round half up on the shortest decimal form of a double."""
    exact = f"cast(cast({value} as varchar) as decimal(38,20))"
    return _number(f"cast({exact} as decimal(38,{digits}))")


CTES: dict[str, tuple[str, str]] = {}


def _cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (needs, sql)


_cte("bronze_neo", "", f"""
select o_orderkey + copy * 1000000000000 as event_id,
       o_orderdate + to_minutes(cast(o_orderkey % 1440 as integer)) as ingestion_timestamp,
       cast(c_custkey as varchar) as neo_id,
       cast(c_custkey as varchar) as neo_reference_id,
       case when copy = 1 then c_name || ' (R)' else c_name end as neo_name,
       c_mktsegment = 'MACHINERY' as is_potentially_hazardous_asteroid,
       cast(c_custkey % 2500 as double) / 100.0 + 10.0 as absolute_magnitude_h,
       {_number("cast(abs(c_acctbal) as decimal(18,2))")} as km_min,
       {_number("cast(abs(c_acctbal) as decimal(18,2)) * 2")} as km_max,
       cast(o_orderdate as date) as close_approach_date,
       strftime(o_orderdate + to_minutes(cast(o_orderkey % 1440 as integer)), '%Y-%b-%d %H:%M')
           as close_approach_date_full,
       date_diff('day', date '1970-01-01', cast(o_orderdate as date)) * 86400000
           + (o_orderkey % 1440) * 60000 as epoch_date_close_approach,
       case when o_orderpriority = '1-URGENT' then 'Moon' else 'Earth' end as orbiting_body,
       cast(200 + o_orderkey % 7000 as double) / 100.0 as rel_velocity_km_s,
       cast((200 + o_orderkey % 7000) * 36 as double) as rel_velocity_km_h,
       {_number("cast((200 + o_orderkey % 7000) * 36 as decimal(18,0)) * cast(0.621371 as decimal(6,6))")}
           as rel_velocity_mi_h,
       {_number("cast(o_totalprice as decimal(18,2))")} as miss_distance_km,
       case when o_orderkey % 97 <> 0
            then {_number("cast(o_totalprice / 3844.0 as decimal(18,6))")} end as miss_distance_lunar,
       {_number("cast(o_totalprice as decimal(18,2)) * cast(0.000000006684587 as decimal(15,15))")}
           as miss_distance_au,
       {_number("cast(o_totalprice as decimal(18,2)) * cast(0.621371 as decimal(6,6))")}
           as miss_distance_miles,
       o_orderpriority = '5-LOW' as is_synthetic
from (select *, unnest(case when o_orderstatus = 'P' then [0, 1] else [0] end) as copy from orders)
join customer on o_custkey = c_custkey""")

_OBJECTS = """
select neo_id, neo_reference_id, neo_name as name, absolute_magnitude_h,
       km_min as estimated_diameter_km_min, km_max as estimated_diameter_km_max,
       is_potentially_hazardous_asteroid, cast(null as boolean) as is_sentry_object,
       cast(null as varchar) as nasa_jpl_url, first_seen_date, last_seen_date
from (select *,
        row_number() over (partition by neo_id order by close_approach_date desc, event_id desc) as rn,
        min(close_approach_date) over (partition by neo_id) as first_seen_date,
        max(close_approach_date) over (partition by neo_id) as last_seen_date
      from bronze_neo {where})
where rn = 1"""
_FACTS = """
select neo_id, close_approach_date, close_approach_date_full, epoch_date_close_approach,
       orbiting_body, rel_velocity_km_s, rel_velocity_km_h, rel_velocity_mi_h, miss_distance_km,
       miss_distance_lunar, miss_distance_au, miss_distance_miles
from (select *, row_number() over (
        partition by neo_id, close_approach_date_full, orbiting_body order by event_id) as rn
      from bronze_neo {where})
where rn = 1"""
_APPROACH_ORDER = (
    "md5(neo_id || '|' || close_approach_date_full || '|' || orbiting_body), "
    "neo_id, close_approach_date_full, orbiting_body"
)
_SNAPSHOT_ORDER = (
    "md5(cast(norad_cat_id as varchar) || '|' || cast(snapshot_date as varchar)), "
    "norad_cat_id, snapshot_date"
)
_NORAD_ORDER = "md5(cast(norad_cat_id as varchar)), norad_cat_id"
_EARLY = f"where close_approach_date < {_EXISTING}"
_EARLY_SNAPSHOT = f"where snapshot_date < {_EXISTING}"

_cte("objects", "bronze_neo", _OBJECTS.format(where=""))
_cte("facts", "bronze_neo", _FACTS.format(where=""))
_cte("neo", "objects", "select row_number() over (order by md5(neo_id), neo_id) as neo_sk, * from objects")
_cte("approaches", "facts neo", f"""
select row_number() over (order by {_APPROACH_ORDER}) as approach_sk, neo_sk, facts.*
from facts join neo using (neo_id)""")
_cte("early_objects", "bronze_neo", _OBJECTS.format(where=_EARLY))
_cte("early_facts", "bronze_neo", _FACTS.format(where=_EARLY))

# Objects as the jobs see them: by the events that bronze has kept, one per approach.
_LANDED_OBJECTS = """
select neo_id, name, first_seen_date, last_seen_date from (
  select neo_id, neo_name as name,
         row_number() over (partition by neo_id order by close_approach_date desc, event_id desc) as rn,
         min(close_approach_date) over (partition by neo_id) as first_seen_date,
         max(close_approach_date) over (partition by neo_id) as last_seen_date
  from (select *, row_number() over (
          partition by neo_id, close_approach_date_full, orbiting_body order by event_id) as copy_number
        from bronze_neo where close_approach_date {sign} """ + _EXISTING + """)
  where copy_number = 1) where rn = 1"""

_cte("records", "", """
select (l_orderkey * 10 + l_linenumber) * 100000000 + l_partkey as id,
       l_shipdate as ingestion_timestamp,
       cast(l_shipdate as date) as snapshot_date,
       case when l_linenumber = 7 then 'all' else 'active' end as source_group,
       case when l_orderkey % 1000 <> 0 then cast(p_partkey as integer) end as norad_cat_id,
       '1998-' || p_partkey as object_id, p_name as object_name, p_type as object_type,
       p_brand as owner, l_linestatus as ops_status_code,
       case when p_partkey % 3 <> 0 then date '1998-01-02' end as launch_date,
       cast(null as varchar) as launch_site, cast(null as date) as decay_date,
       'EA' as orbit_center, cast(null as varchar) as orbit_type,
       case when p_size % 5 <> 0 then cast(p_size as double) end as rcs,
       case when p_size % 11 <> 0 then cast(cast(
         cast(90 + p_size * 20 as double) + l_tax * 100.0 as decimal(18,2)) as double) end
         as period_minutes,
       cast(cast(l_discount * case when p_brand = 'Brand#1' then 50.0 else 1000.0 end
         as decimal(18,2)) as double) as inclination_deg,
       cast(case when p_brand = 'Brand#1' then 35786 + cast(l_quantity as bigint)
            else p_size * 800 + cast(l_quantity as bigint) * 10 end as double) as apogee_km,
       cast(case when p_brand = 'Brand#1' then 35786 - cast(l_quantity as bigint)
            when p_brand = 'Brand#2' then 500 else p_size * 700 end as double) as perigee_km
from lineitem join part on l_partkey = p_partkey""")
_cte("parsed", "records", "select * from records where norad_cat_id is not null")

_CATALOG = """
select norad_cat_id, object_id, object_name, object_type, owner, ops_status_code, launch_date,
       launch_site, decay_date, orbit_center, orbit_type, rcs, first_seen_date, last_seen_date
from (select *,
        row_number() over (partition by norad_cat_id order by snapshot_date desc, id desc) as rn,
        min(snapshot_date) over (partition by norad_cat_id) as first_seen_date,
        max(snapshot_date) over (partition by norad_cat_id) as last_seen_date
      from parsed {where})
where rn = 1"""
_ORBITS = """
select norad_cat_id, snapshot_date, period_minutes, inclination_deg, apogee_km, perigee_km,
       cast(null as double) as ecc, cast(null as double) as mean_motion_rev_per_day, source_group
from (select *, row_number() over (partition by norad_cat_id, snapshot_date order by id) as rn
      from parsed {where})
where rn = 1"""
_cte("catalog", "parsed", _CATALOG.format(where=""))
_cte("orbits", "parsed", _ORBITS.format(where=""))
_cte("early_catalog", "parsed",
     _CATALOG.format(where=_EARLY_SNAPSHOT.replace(EXISTING_BEFORE, SATELLITES_BEFORE)))
_cte("early_orbits", "parsed", _ORBITS.format(where=_EARLY_SNAPSHOT))
_cte("satellites", "catalog", f"select row_number() over (order by {_NORAD_ORDER}) as satellite_sk, * from catalog")
_cte("snapshots", "orbits satellites", f"""
select row_number() over (order by {_SNAPSHOT_ORDER}) as orbit_snapshot_sk, satellite_sk, orbits.*
from orbits join satellites using (norad_cat_id)""")

_cte("daily", "facts objects", """
select close_approach_date, count(*) as total_approaches, count(distinct neo_id) as unique_objects,
       cast(sum(case when is_potentially_hazardous_asteroid then 1 else 0 end) as bigint)
         as hazardous_approaches
from facts join objects using (neo_id) group by close_approach_date""")
_cte("hazard", "facts objects", """
select neo_id, max(name) as name, bool_or(is_potentially_hazardous_asteroid) as is_hazardous,
       count(*) as total_approaches, min(close_approach_date) as first_approach_date,
       max(close_approach_date) as last_approach_date, min(miss_distance_km) as closest_approach_km
from facts left join objects using (neo_id) group by neo_id""")


def _exact_avg(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(38,9))) as double) / nullif(count({column}), 0)"


_cte("orbit_summary", "catalog orbits", f"""
select norad_cat_id, max(object_name) as object_name, max(object_type) as object_type,
       max(owner) as owner, count(*) as snapshot_count, min(snapshot_date) as first_snapshot_date,
       max(snapshot_date) as last_snapshot_date,
       {_exact_avg("period_minutes")} as avg_period_minutes,
       {_exact_avg("inclination_deg")} as avg_inclination_deg,
       {_exact_avg("apogee_km")} as avg_apogee_km, {_exact_avg("perigee_km")} as avg_perigee_km
from orbits join catalog using (norad_cat_id) group by norad_cat_id""")
_cte("neo_features", "approaches objects", """
select approach_sk, neo_id, close_approach_date, rel_velocity_km_s, rel_velocity_km_h,
       miss_distance_km, miss_distance_lunar, miss_distance_au, absolute_magnitude_h,
       case when is_potentially_hazardous_asteroid then 1 else 0 end as is_hazardous_label
from approaches join objects using (neo_id)""")
_cte("satcat_features", "snapshots catalog", """
select orbit_snapshot_sk, norad_cat_id, snapshot_date, period_minutes, inclination_deg, apogee_km,
       perigee_km, object_type, owner
from snapshots join catalog using (norad_cat_id)""")

_ECC = _round("(apogee_km - perigee_km) / (2.0 * (6371.0 + (perigee_km + apogee_km) / 2.0))", 7)
_REGIME = f"""case
  when apogee_km is null or perigee_km is null or inclination_deg is null then 'UNKNOWN'
  when abs(apogee_km - 35786) <= 200 and abs(perigee_km - 35786) <= 200 and abs(inclination_deg) <= 5
    then 'GEO'
  when {_ECC} >= 0.25 then 'HEO' when apogee_km < 2000 then 'LEO' else 'MEO' end"""
_cte("latest", "orbits", f"""
select *, {_REGIME} as orbit_regime
from (select *, row_number() over (partition by norad_cat_id order by snapshot_date desc) as rn
      from orbits) where rn = 1""")

_ELEMENTS = ("period_minutes", "apogee_km", "perigee_km")
_cte("deltas", "orbits", "select norad_cat_id, snapshot_date, lag(snapshot_date) over h as previous_date, "
     + ", ".join(f"{c} - lag({c}) over h as delta_{c}" for c in _ELEMENTS)
     + " from orbits window h as (partition by norad_cat_id order by snapshot_date)")
_cte("scores", "deltas", "select norad_cat_id, snapshot_date, "
     + ", ".join(
         _round(f"(delta_{c} - avg(delta_{c}) over s) / nullif(stddev_samp(delta_{c}) over s, 0)", 6)
         + f" as z_{c}" for c in _ELEMENTS)
     + " from deltas window s as (partition by norad_cat_id)")
_cte("anomalies", "scores", "select *, greatest("
     + ", ".join(f"abs(z_{c})" for c in _ELEMENTS) + ") as anomaly_score from scores")

_cte("runs", "", """
select cast(o_orderkey as varchar) as run_id, o_orderpriority as pipeline_name,
       'scheduler' as triggered_by, start_time,
       case when o_orderstatus <> 'O' then start_time + to_minutes(cast(o_orderkey % 90 + 1 as integer))
         end as end_time,
       case o_orderstatus when 'F' then 'failed' when 'O' then 'running' else 'success' end as status,
       case when o_orderstatus <> 'O' then o_custkey end as records_processed,
       case when o_orderstatus = 'F' then 'boom' end as error_message
from (select *, o_orderdate + to_minutes(cast(o_orderkey % 1440 as integer)) as start_time
      from orders)""")


# --- quality checks as SQL ---------------------------------------------------

_TABLE_SQL = {
    "silver.neo": "neo",
    "silver.neo_close_approach": "approaches",
    "silver.satcat_satellite": "satellites",
    "silver.satcat_orbit_snapshot": "snapshots",
    "gold.neo_daily_activity": "daily",
    "gold.neo_hazard_summary": "hazard",
    "gold.satcat_orbit_summary": "orbit_summary",
    "gold.ai_neo_features": "neo_features",
    "gold.ai_satcat_features": "satcat_features",
}


def _check_sql(table: str, check: Check) -> str:
    source = _TABLE_SQL[table]
    columns = ", ".join(check.columns)
    total = f"(select count(*) from {source})"
    if check.kind == "unique":
        failed = (
            f"(select count(*) from (select 1 from {source} group by {columns} having count(*) > 1))"
        )
    else:
        condition = {
            "non_null": f"{columns} is null",
            "accepted": f"{columns} not in ({', '.join(map(str, check.accepted))})",
            "range": " or ".join(
                [f"{columns} < {check.low}"] * (check.low is not None)
                + [f"{columns} > {check.high}"] * (check.high is not None)
            ),
        }[check.kind]
        failed = f"(select count(*) from {source} where {condition})"
    return (
        f"select '{check.name}' as check_name, {total} as total_records, "
        f"{failed} as failed_records, '{check.details}' as details"
    )


def _checks_sql(checks: dict[str, list[Check]]) -> str:
    return " union all ".join(_check_sql(t, c) for t, list_ in checks.items() for c in list_)


_cte("job_checks", "neo approaches satellites snapshots", _checks_sql(JOB_GATES))
_cte("table_checks", " ".join(dict.fromkeys(_TABLE_SQL.values())), _checks_sql(TABLE_TESTS))

_STATUS = "case when failed_records = 0 then 'pass' else 'fail' end as status"

_DIAMETER = "1329.0::double / sqrt(0.154::double) * pow(10.0::double, -absolute_magnitude_h / 5.0)"
_KM_H = _round("rel_velocity_km_s * 3600.0", 3)

# --- queries: name -> (CTEs it reads, final select) ---------------------------

# Counts and ROC AUC of the score "whole magnitudes, cut at 22".
_RULE_COUNTS = """from (
  select count(*)::double as n,
         count(*) filter (y = 1 and s >= -22)::double as tp,
         count(*) filter (y = 0 and s >= -22)::double as fp,
         count(*) filter (y = 1 and s < -22)::double as fn,
         count(*) filter (y = 0 and s < -22)::double as tn,
         (sum(mid) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0::double)
           / (count(*) filter (y = 1) * count(*) filter (y = 0)) as auc
  from (select y, s, rank() over (order by s)
               + (count(*) over (partition by s) - 1) / 2.0::double as mid
        from (select is_hazardous_label as y, -floor(absolute_magnitude_h) as s from neo_features)))"""

_QUERIES: dict[str, tuple[str, str]] = {
    "neo_feed_flatten": ("", """
select date '1995-01-01' as feed_start_date, date '1995-01-07' as feed_end_date,
       cast(c_custkey as varchar) as neo_id, cast(null as varchar) as neo_reference_id,
       c_name as neo_name, c_mktsegment = 'MACHINERY' as is_potentially_hazardous_asteroid,
       cast(cast(abs(c_acctbal) as decimal(18,2)) * 2 as double) as diameter_km_max,
       cast(o_orderdate as date) + nth * 30 as close_approach_date,
       cast(cast(o_orderdate as date) + nth * 30 as varchar) || ' 00:00' as close_approach_date_full,
       o_orderkey as epoch_date_close_approach,
       case when nth = 0 then cast(cast(o_totalprice as decimal(18,2)) as varchar) end as miss_km,
       case when nth = 0 then 'Earth' else 'Moon' end as orbiting_body,
       c_name as raw_name
from (select *, unnest([0, 1]) as nth from orders where o_orderstatus <> 'P')
join customer on o_custkey = c_custkey"""),
    "satcat_csv_record": ("", """
select 'active' as snapshot_group, date '1998-01-02' as snapshot_date,
       p_partkey || ',' || name || ',' || rcs || ',' || p_brand as raw_csv_row,
       '{"NORAD_CAT_ID":"' || p_partkey || '","OBJECT_NAME":"' || name || '","RCS":"' || rcs
         || '","OWNER":"' || p_brand || '"}' as parsed_record
from (select *, p_name || ', ' || p_type as name,
             case when p_size > 10 then cast(p_size as varchar) else '' end as rcs from part)"""),
    "backfill_windows": ("", """
select o_orderpriority, cast(window_start as date) as window_start,
       least(cast(window_start as date) + 6, last_day) as window_end
from (select o_orderpriority, last_day, unnest(generate_series(first_day, last_day, interval 7 day)) as window_start
      from (select o_orderpriority, min(cast(o_orderdate as date)) as first_day,
                   max(cast(o_orderdate as date)) as last_day from orders group by 1))"""),
    "bronze_neo_dedup": ("bronze_neo", f"""
select event_id, neo_id, close_approach_date_full, orbiting_body, neo_name, close_approach_date
from (select *, row_number() over (
        partition by neo_id, close_approach_date_full, orbiting_body order by event_id) as rn
      from bronze_neo) as a
where rn = 1 and not exists (
  select 1 from bronze_neo as s where s.close_approach_date < {_EXISTING}
    and s.neo_id is not distinct from a.neo_id
    and s.close_approach_date_full is not distinct from a.close_approach_date_full
    and s.orbiting_body is not distinct from a.orbiting_body)"""),
    "bronze_satcat_load_once": ("records", f"""
select * from (with arrivals as (select id, snapshot_date,
    case when id // 100000000 % 10 <> 3 then source_group end as snapshot_group from records)
select id, snapshot_group, snapshot_date from arrivals as a
where not exists (select 1 from arrivals as s where s.snapshot_date < {_EXISTING}
  and s.snapshot_group is not distinct from a.snapshot_group and s.snapshot_date = a.snapshot_date))"""),
    "bronze_without_synthetic": ("bronze_neo", """
select event_id, neo_id from bronze_neo where not is_synthetic"""),
    "silver_neo_dimension": ("neo", "select * from neo"),
    "silver_neo_close_approach": ("approaches", "select * from approaches"),
    "silver_satcat_satellite": ("satellites", "select * from satellites"),
    "silver_satcat_orbit_snapshot": ("snapshots", "select * from snapshots"),
    "silver_satcat_records_variant": ("parsed", """
select id, snapshot_date, source_group, norad_cat_id, object_id, object_name, object_type, owner,
       ops_status_code, launch_date, launch_site, decay_date, orbit_center, orbit_type, rcs,
       period_minutes, inclination_deg, apogee_km, perigee_km
from parsed"""),
    "merge_pruned_neo": ("bronze_neo facts objects early_objects", f"""
select o.neo_id, coalesce(e.name, late.name) as name,
       coalesce(e.first_seen_date, late.first_seen_date) as first_seen_date,
       coalesce(e.last_seen_date, late.last_seen_date) as last_seen_date,
       case when e.neo_id is null then 'silver-late' else 'silver-early' end as load_run
from objects as o left join (select * from ({_LANDED_OBJECTS.format(sign="<")})) as e using (neo_id)
left join (select * from ({_LANDED_OBJECTS.format(sign=">=")})) as late using (neo_id)"""),
    "merge_new_neo": ("objects early_objects", """
select (select count(*) from early_objects) + row_number() over (order by md5(neo_id), neo_id) as neo_sk,
       neo_id, name, first_seen_date, last_seen_date
from objects where neo_id not in (select neo_id from early_objects)"""),
    "merge_new_approach": ("facts early_facts neo", f"""
select (select count(*) from early_facts) + row_number() over (order by {_APPROACH_ORDER}) as approach_sk,
       neo_sk, neo_id, close_approach_date_full, orbiting_body, miss_distance_km
from (select f.*, neo_sk from facts as f join neo using (neo_id) where not exists (
  select 1 from early_facts as e where e.neo_id is not distinct from f.neo_id
    and e.close_approach_date_full is not distinct from f.close_approach_date_full
    and e.orbiting_body is not distinct from f.orbiting_body))"""),
    "merge_new_satellite": ("catalog early_catalog", f"""
select (select count(*) from early_catalog) + row_number() over (order by {_NORAD_ORDER}) as satellite_sk,
       norad_cat_id, object_name, first_seen_date
from catalog where norad_cat_id not in (select norad_cat_id from early_catalog)"""),
    "merge_new_snapshot": ("orbits early_orbits satellites", f"""
select (select count(*) from early_orbits) + row_number() over (order by {_SNAPSHOT_ORDER})
         as orbit_snapshot_sk, satellite_sk, norad_cat_id, snapshot_date, apogee_km
from (select o.*, satellite_sk from orbits as o join satellites using (norad_cat_id)
      where not exists (select 1 from early_orbits as e
        where e.norad_cat_id = o.norad_cat_id and e.snapshot_date = o.snapshot_date))"""),
    "surrogate_keys": ("", """
select row_number() over (order by md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|'
         || cast(l_shipdate as date)), l_orderkey, l_linenumber, l_partkey, l_shipdate) as line_sk,
       l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as day
from lineitem"""),
    "gold_neo_daily_activity": ("daily", "select * from daily"),
    "gold_neo_hazard_summary": ("hazard", "select * from hazard"),
    "gold_satcat_orbit_summary": ("orbit_summary", "select * from orbit_summary"),
    "gold_ai_neo_features": ("neo_features", "select * from neo_features"),
    "gold_ai_satcat_features": ("satcat_features", "select * from satcat_features"),
    "approaches_within_ld_daily": ("facts", f"""
select close_approach_date as period_start, count(*) as approaches from facts
where miss_distance_lunar <= {LUNAR_LIMIT} group by 1"""),
    "approaches_within_ld_weekly": ("facts", f"""
select cast(date_trunc('week', close_approach_date) as date) as period_start, count(*) as approaches
from facts where miss_distance_lunar <= {LUNAR_LIMIT} group by 1"""),
    "top_closest_approaches": ("approaches objects", """
select approach_sk, name, close_approach_date, miss_distance_lunar, rel_velocity_km_s,
       is_potentially_hazardous_asteroid
from approaches join objects using (neo_id)
order by miss_distance_lunar nulls last, approach_sk limit 20"""),
    "hazardous_by_closeness": ("hazard", """
select neo_id, name, total_approaches, closest_approach_km, is_hazardous,
       row_number() over (order by closest_approach_km nulls last, neo_id) as place
from hazard where is_hazardous"""),
    "approach_bands_daily": ("facts", f"""
select close_approach_date, min(miss_distance_lunar) as min_ld,
       {_exact_avg("rel_velocity_km_s")} as avg_velocity, max(rel_velocity_km_s) as max_velocity
from facts group by 1"""),
    "discovery_monthly": ("objects", """
select cast(date_trunc('month', first_seen_date) as date) as month, count(*) as discoveries
from objects group by 1"""),
    "hazard_briefing_7d": ("approaches objects", f"""
select approach_sk, neo_id, name, close_approach_date, miss_distance_lunar, miss_distance_km,
       rel_velocity_km_s, is_potentially_hazardous_asteroid,
       row_number() over (order by is_potentially_hazardous_asteroid desc, miss_distance_lunar,
                                   approach_sk) as place
from approaches join objects using (neo_id)
where close_approach_date between date '{BRIEFING_DAY}' and date '{BRIEFING_DAY}' + 6
  and miss_distance_lunar <= {LUNAR_LIMIT}"""),
    "neo_diameter_units": ("objects", f"""
select neo_id, absolute_magnitude_h, min_km, max_km,
       min_km * 1000.0 as min_m, min_km * 0.621371 as min_mi, min_km * 1000.0 * 3.28084 as min_ft,
       max_km * 1000.0 as max_m, max_km * 0.621371 as max_mi, max_km * 1000.0 * 3.28084 as max_ft
from (select neo_id, absolute_magnitude_h,
        {_round(_DIAMETER + " * 0.8::double", 6)} as min_km,
        {_round(_DIAMETER + " * 1.2::double", 6)} as max_km
      from objects)"""),
    "approach_unit_conversions": ("approaches", f"""
select approach_sk, miss_distance_km, {_round("miss_distance_km / 384400.0", 4)} as lunar,
       {_round("miss_distance_km / 149600000.0", 9)} as au,
       {_round("miss_distance_km * 0.621371", 2)} as miles,
       rel_velocity_km_s, {_KM_H} as km_h, {_round(_KM_H + " * 0.621371", 3)} as mi_h
from approaches"""),
    "approach_time_parse": ("facts", """
select neo_id, close_approach_date_full, epoch_date_close_approach,
       make_timestamp(epoch_date_close_approach * 1000) as approach_time,
       close_approach_date_full as written_back
from facts"""),
    "neo_names_normalized": ("objects", """
select neo_id, lower(trim('  ' || name || ' ')) as name_normalized from objects"""),
    "satellites_by_regime": ("latest", """
select orbit_regime, count(*) as satellite_count from latest group by 1"""),
    "satellites_by_regime_owner": ("latest catalog", """
select orbit_regime, owner, count(*) as satellite_count
from latest join catalog using (norad_cat_id) group by 1, 2"""),
    "owner_inclination_band": ("catalog orbits", """
select norad_cat_id, object_name, owner, snapshot_date, inclination_deg,
       row_number() over (order by inclination_deg, norad_cat_id, snapshot_date) as place
from orbits join catalog using (norad_cat_id)
where owner = 'Brand#7' and inclination_deg between 50 and 60"""),
    "satellite_profile": ("orbit_summary", """
select norad_cat_id, object_name, avg_period_minutes, avg_apogee_km, avg_perigee_km,
       avg_inclination_deg
from orbit_summary where norad_cat_id = 42"""),
    "satellite_lookup_stored": ("satellites", "select * from satellites where norad_cat_id = 42"),
    "orbit_history": ("orbits", """
select norad_cat_id, snapshot_date, period_minutes, apogee_km, perigee_km,
       row_number() over h as snapshot_number,
       row_number() over h > 1 and (period_minutes is distinct from lag(period_minutes) over h
         or apogee_km is distinct from lag(apogee_km) over h
         or perigee_km is distinct from lag(perigee_km) over h) as is_changed
from orbits window h as (partition by norad_cat_id order by snapshot_date)"""),
    "orbit_deltas": ("deltas", "select * from deltas"),
    "orbit_anomaly_zscore": ("anomalies", "select * from anomalies"),
    "orbit_anomaly_incremental": ("anomalies", f"""
select * from anomalies where snapshot_date >= {_EXISTING}"""),
    "orbit_anomaly_top": ("anomalies", """
select norad_cat_id, snapshot_date, anomaly_score from anomalies where anomaly_score is not null
order by anomaly_score desc, norad_cat_id, snapshot_date limit 20"""),
    "orbit_elements_derived": ("orbits", f"""
select norad_cat_id, snapshot_date, apogee_km, perigee_km, eccentricity, circular_period_minutes,
       {_round("1440.0 / nullif(circular_period_minutes, 0)", 8)} as mean_motion_rev_per_day,
       orbit_regime
from (select *, {_ECC} as eccentricity, {_REGIME} as orbit_regime,
        {_round("2.0 * pi() * sqrt(r * r * r / 398600.4418) / 60.0", 3)} as circular_period_minutes
      from (select *, 6371.0 + (perigee_km + apogee_km) / 2.0 as r from orbits))"""),
    "latest_orbit_snapshot": ("latest", """
select norad_cat_id, snapshot_date, period_minutes, apogee_km, perigee_km, source_group
from latest"""),
    "dq_job_checks": ("job_checks", f"""
select check_name, {_STATUS}, total_records, failed_records, details from job_checks"""),
    "dq_table_tests": ("table_checks", f"""
select check_name, {_STATUS}, total_records, failed_records from table_checks"""),
    "dq_pass_rates": ("job_checks", """
select check_name, total_records, failed_records,
       (total_records - failed_records) * 100.0::double / total_records as pass_percent
from job_checks"""),
    "dq_duplicates": ("bronze_neo", """
select neo_id, close_approach_date_full, orbiting_body, count(*) as row_count
from bronze_neo group by 1, 2, 3 having count(*) > 1"""),
    "dq_foreign_keys": ("facts early_objects", """
select neo_id, count(*) as row_count from facts
where neo_id not in (select neo_id from early_objects) group by 1"""),
    "reconcile_gold_silver": ("daily facts", """
select close_approach_date, coalesce(total_approaches, 0) as gold_total,
       coalesce(silver_total, 0) as silver_total,
       coalesce(total_approaches, 0) - coalesce(silver_total, 0) as difference
from (select close_approach_date, count(*) as silver_total from facts group by 1)
full join (select close_approach_date, total_approaches from daily
           where close_approach_date > (select min(close_approach_date) from facts)
           union all select max(close_approach_date) + 1, 5 from daily) using (close_approach_date)"""),
    "daily_activity_by_date": ("daily", """
select *, row_number() over (order by close_approach_date nulls last) as place from daily"""),
    "reconcile_totals": ("daily hazard facts", """
select 'gold.neo_daily_activity' as source, cast(sum(total_approaches) as bigint) as total from daily
union all select 'gold.neo_hazard_summary', cast(sum(total_approaches) as bigint) from hazard
union all select 'silver.neo_close_approach', count(*) from facts"""),
    "layer_row_counts": ("bronze_neo records objects facts catalog orbits daily", """
select 'bronze.neo_event_raw' as table_name, count(*) as row_count from bronze_neo
union all select 'bronze.satcat_raw', count(*) from records
union all select 'silver.neo', count(*) from objects
union all select 'silver.neo_close_approach', count(*) from facts
union all select 'silver.satcat_satellite', count(*) from catalog
union all select 'silver.satcat_orbit_snapshot', count(*) from orbits
union all select 'gold.neo_daily_activity', count(*) from daily
union all select 'gold.ai_neo_features', count(*) from facts join objects using (neo_id)"""),
    "freshness": ("bronze_neo", f"""
select latest_ingest, date_sub('second', latest_ingest, {_NOW}) as lag_seconds,
       date_sub('second', latest_ingest, {_NOW}) <= 86400 as is_fresh
from (select max(ingestion_timestamp) as latest_ingest from bronze_neo)"""),
    "run_state": ("runs", "select * from runs"),
    "supervision_failed": ("runs", f"""
select pipeline_name, run_id, start_time, status, error_message from runs
where pipeline_name in ({_PIPELINES}) and status = 'failed'
  and start_time > {_NOW} - interval 720 hour
order by start_time desc, run_id limit 20"""),
    "supervision_stale": ("runs", f"""
select pipeline_name, run_id, start_time,
       row_number() over (order by start_time, run_id) as place
from runs where pipeline_name in ({_PIPELINES}) and status = 'running'
  and start_time < {_NOW} - interval 15 minute"""),
    "supervision_issues": ("runs", f"""
select pipeline_name, issue, count(*) as runs from (
  select pipeline_name,
         case when status = 'failed' and start_time > {_NOW} - interval 1 hour then 'failed'
              when status = 'running' and start_time < {_NOW} - interval 15 minute then 'stale'
         end as issue
  from runs where pipeline_name in ({_PIPELINES}))
where issue is not null group by 1, 2"""),
    "recent_runs": ("runs", """
select pipeline_name, run_id, status, start_time,
       date_sub('second', start_time, end_time) as duration_seconds
from runs order by start_time desc, run_id limit 20"""),
    "latest_run_health": ("runs", f"""
select pipeline_name, run_id, start_time, end_time, status,
       coalesce(status = 'success' and end_time >= {_NOW} - interval 24 hour, false) as is_healthy
from (select *, row_number() over (partition by pipeline_name order by start_time desc, run_id desc) as rn
      from runs) where rn = 1"""),
    "run_kpis": ("runs", """
select cast(date_trunc('week', start_time) as date) as week, count(*) as runs,
       round(count(*) filter (status = 'success') * 100.0::double / count(*), 6) as success_percent,
       round(avg(date_sub('second', start_time, end_time)), 6) as mean_seconds,
       round(var_samp(date_sub('second', start_time, end_time)), 3) as variance_seconds
from runs group by 1"""),
    "message_encode": ("bronze_neo", """
select neo_id as key, neo_name, case when is_potentially_hazardous_asteroid then 'true' else 'false' end
         as hazardous, cast(close_approach_date as varchar) as day, km_max as diameter_max,
       cast(cast(rel_velocity_km_s as decimal(18,2)) as varchar) as km_per_second,
       case when miss_distance_lunar is null then ''
            else cast(cast(miss_distance_lunar as decimal(18,6)) as varchar) end as lunar,
       neo_id as raw_id
from bronze_neo"""),
    "message_encode_catalog": ("records", """
select coalesce(cast(norad_cat_id as varchar), '') as key, source_group as snapshot_group,
       strftime(ingestion_timestamp, '%Y-%m-%dT%H:%M:%S.%f') as snapshot_timestamp,
       object_name, cast(cast(apogee_km as bigint) as varchar) as apogee
from records"""),
    "stream_neo_to_bronze": ("facts", """
select neo_id, close_approach_date_full, orbiting_body, close_approach_date,
       epoch_date_close_approach, rel_velocity_km_s, miss_distance_km, miss_distance_lunar
from facts"""),
    "stream_satcat_to_bronze": ("parsed", """
select norad_cat_id, snapshot_date, source_group, count(*) as messages,
       min(apogee_km) as min_apogee_km, max(perigee_km) as max_perigee_km
from parsed group by 1, 2, 3"""),
    "stream_quarantine": ("", """
select 'satcat_stream_to_bronze' as stream,
       case event_type when 'error' then 'malformed' when 'view' then 'missing key'
            else 'missing timestamp' end as reason, count(*) as messages
from events where event_type in ('error', 'view', 'click') group by 1, 2"""),
    "ml_stratified_split": ("neo_features", """
select approach_sk, is_hazardous_label,
       case when number <= round(size * 0.25::double) then 'test' else 'train' end as split
from (select *, row_number() over (partition by is_hazardous_label
                                   order by md5(cast(approach_sk as varchar)), approach_sk) as number,
             count(*) over (partition by is_hazardous_label) as size from neo_features)"""),
    "ml_active_top_predictions": ("anomalies", """
select cast(norad_cat_id as varchar) as entity_key, cast(snapshot_date as varchar) as snapshot_ref,
       case when anomaly_score > 3 then 'anomaly' else 'normal' end as predicted_label,
       anomaly_score as predicted_score
from anomalies where anomaly_score is not null
order by anomaly_score desc, cast(snapshot_date as varchar), cast(norad_cat_id as varchar) limit 20"""),
    "ml_hazard_scores": ("neo_features", """
select neo_id as entity_key, cast(approach_sk as varchar) as snapshot_ref, true as in_range,
       true as label_follows,
       rel_velocity_km_s is null or miss_distance_km is null or miss_distance_lunar is null
         or absolute_magnitude_h is null as is_imputed
from neo_features"""),
    "ml_hazard_metrics": ("neo_features", f"""
select metric_name, true as in_range, case when metric_name = 'roc_auc' then rule_auc end as rule_auc,
       case when metric_name = 'roc_auc' then true end as beats_rule
from (select unnest(['roc_auc', 'f1', 'accuracy', 'precision', 'recall']) as metric_name,
             round(auc, 9) as rule_auc {_RULE_COUNTS})"""),
    "ml_binary_metrics": ("neo_features", f"""
select unnest(['roc_auc', 'f1', 'accuracy', 'precision', 'recall']) as metric_name,
       round(unnest([auc, 2.0::double * tp / (2 * tp + fp + fn), (tp + tn) / n,
                     tp / (tp + fp), tp / (tp + fn)]), 9) as metric_value
{_RULE_COUNTS}"""),
    "ml_regime_agreement": ("latest", """
select orbit_regime, count(*) as satellites,
       count(*) filter (period_minutes is null or inclination_deg is null or apogee_km is null
                        or perigee_km is null) as without_prediction,
       (select max(n) from (select count(*) as n from latest where period_minutes is not null
          and inclination_deg is not null and apogee_km is not null and perigee_km is not null
          group by orbit_regime)) as largest_class, true as beats_it
from latest group by 1"""),
    "ml_class_metrics": ("latest", """
select * from (with pairs as (
  select orbit_regime as a, case when apogee_km < 20000 then 'LEO' else 'GEO' end as b from latest
), classes as (
  select c, count(*) filter (a = c and b = c)::double as tp, count(*) filter (a = c)::double as n,
         count(*) filter (b = c)::double as guessed
  from pairs, (select distinct a as c from pairs where a is not null) group by c
)
select unnest(['accuracy', 'macro_f1']) as metric_name,
       round(unnest([sum(tp) / sum(n), avg(2 * tp / (n + guessed))]), 9) as metric_value
from classes)"""),
    "ml_clusters": ("latest", """
select norad_cat_id, period_minutes is not null and inclination_deg is not null
         and apogee_km is not null and perigee_km is not null as is_clustered,
       true as in_range, true as silhouette_in_range, true as beats_rule,
       (with complete as (
          select * from latest where period_minutes is not null and inclination_deg is not null
            and apogee_km is not null and perigee_km is not null
        ), inside as (
          select count(*) * var_pop(period_minutes) as p, count(*) * var_pop(inclination_deg) as i,
                 count(*) * var_pop(apogee_km) as a, count(*) * var_pop(perigee_km) as g
          from complete group by orbit_regime
        ), whole as (
          select count(*) * var_pop(period_minutes) as p, count(*) * var_pop(inclination_deg) as i,
                 count(*) * var_pop(apogee_km) as a, count(*) * var_pop(perigee_km) as g
          from complete
        )
        select round((sum(inside.p) / any_value(whole.p) + sum(inside.i) / any_value(whole.i)
                      + sum(inside.a) / any_value(whole.a) + sum(inside.g) / any_value(whole.g)) / 4, 9)
        from inside, whole) as rule_share
from latest"""),
    "ml_active_model_metrics": ("neo_features", f"""
select 'neo_hazard_classifier' as model_name, 2 as model_version, 'test' as dataset_split,
       unnest(['roc_auc', 'f1', 'accuracy', 'precision', 'recall']) as metric_name,
       round(unnest([auc, 2.0::double * tp / (2 * tp + fp + fn), (tp + tn) / n,
                     tp / (tp + fp), tp / (tp + fn)]), 9) as metric_value
{_RULE_COUNTS}"""),
    "ml_hazard_top_risk": ("neo_features", """
select neo_id as entity_key, cast(approach_sk as varchar) as snapshot_ref,
       case when risk > 0.05::double then '1' else '0' end as predicted_label, risk as predicted_score
from (select *, 1.0::double / (1.0::double + absolute_magnitude_h) as risk from neo_features)
order by risk desc nulls last, cast(approach_sk as varchar), neo_id limit 20"""),
    "job_neo_increment": ("facts", """
select neo_id, close_approach_date_full, orbiting_body, close_approach_date, rel_velocity_km_s,
       miss_distance_km, true as key_fits from facts"""),
    "job_satcat_increment": ("orbits", """
select norad_cat_id, count(*) as snapshots, 1::bigint as keys, min(snapshot_date) as first_day,
       max(snapshot_date) as last_day from orbits group by 1"""),
    "job_rerun_counts": ("objects facts catalog orbits", """
select table_name, n as first_run, n as second_run from (
  select 'silver.neo' as table_name, count(*) as n from objects
  union all select 'silver.neo_close_approach', count(*) from facts
  union all select 'silver.satcat_satellite', count(*) from catalog
  union all select 'silver.satcat_orbit_snapshot', count(*) from orbits)"""),
    "job_dq_ledger": ("objects", """
select check_name, case when failed = 0 then 'pass' else 'fail' end as status,
       (select count(*) from objects) as total_records, failed as failed_records,
       'failed' as run_status, 0::bigint as rows_added
from (select 'silver.neo.non_null_neo_id' as check_name, 0::bigint as failed
      union all select 'silver.neo.unique_neo_id', 0
      union all select 'silver.neo.non_null_hazard_flag', 0
      union all select 'silver.neo.abs_mag_reasonable_range',
             (select count(*) from objects where absolute_magnitude_h + 29.5 > 40))"""),
    "job_gold_tables": ("daily hazard orbit_summary facts objects orbits", """
select 'gold.neo_daily_activity' as table_name, count(*) as row_count,
       cast(sum(total_approaches) as bigint) as total from daily
union all select 'gold.neo_hazard_summary', count(*), cast(sum(total_approaches) as bigint) from hazard
union all select 'gold.satcat_orbit_summary', count(*), cast(sum(snapshot_count) as bigint) from orbit_summary
union all select 'gold.ai_neo_features', count(*), count(*) from facts join objects using (neo_id)
union all select 'gold.ai_satcat_features', count(*), count(*) from orbits"""),
    "job_gold_increment": ("daily hazard orbit_summary facts objects orbits", """
select 'gold.neo_daily_activity' as mart, cast(unique_objects as varchar) as entity,
       close_approach_date as day, total_approaches as n, cast(hazardous_approaches as double) as value
from daily
union all select 'gold.neo_hazard_summary', neo_id, last_approach_date, total_approaches,
       closest_approach_km from hazard
union all select 'gold.satcat_orbit_summary', cast(norad_cat_id as varchar), last_snapshot_date,
       snapshot_count, avg_apogee_km from orbit_summary
union all select 'gold.ai_neo_features', neo_id, close_approach_date,
       case when is_potentially_hazardous_asteroid then 1 else 0 end, miss_distance_km
from facts join objects using (neo_id)
union all select 'gold.ai_satcat_features', cast(norad_cat_id as varchar), snapshot_date, null,
       perigee_km from orbits"""),
    "stream_ledger": ("records", """
select 'satcat_stream_to_bronze' as pipeline_name, 'stream' as triggered_by, 'success' as status,
       (select count(*) from lineitem join part on l_partkey = p_partkey) as records, true as in_order"""),
    "feed_to_messages": ("", """
select cast(c_custkey as varchar) as key, c_name as neo_name,
       cast(cast(o_orderdate as date) + nth * 30 as varchar) as day,
       case when nth = 0 then cast(cast(o_totalprice as decimal(18,2)) as varchar) end as kilometers
from (select *, unnest([0, 1]) as nth from orders where o_orderstatus <> 'P')
join customer on o_custkey = c_custkey"""),
    "freshness_silver": ("runs", f"""
select latest_ingest, date_sub('second', latest_ingest, {_NOW}) as lag_seconds,
       date_sub('second', latest_ingest, {_NOW}) <= 1800 as is_fresh
from (select max(end_time) as latest_ingest from runs where status = 'success')"""),
    "dq_recent": ("job_checks", """
select 'silver' as run_id, check_name, case when failed_records = 0 then 'pass' else 'fail' end
         as status, total_records, failed_records,
       row_number() over (order by check_name not like 'silver.neo_close_approach.%', check_name)
         as place
from job_checks where check_name like 'silver.neo%'"""),
    "stream_neo_stateful": ("facts", """
select neo_id, close_approach_date_full, orbiting_body, 1::bigint as copies, 1::bigint as ids
from facts"""),
    "stream_satcat_file_sink": ("parsed", """
select norad_cat_id, snapshot_date, source_group, count(*) as messages,
       min(apogee_km) as min_apogee_km, max(perigee_km) as max_perigee_km
from parsed group by 1, 2, 3"""),
    "stream_silver_lag": ("", """
select 'satcat_stream_to_bronze' as stream,
       (select count(*) from lineitem join part on l_partkey = p_partkey) as input_rows,
       true as is_fresh, true as in_order"""),
}


def _with(needs: str) -> list[str]:
    """CTE names in dependency order."""
    order: list[str] = []
    for name in needs.split():
        for inner in _with(CTES[name][0]) + [name]:
            if inner not in order:
                order.append(inner)
    return order


def sql(name: str) -> str:
    needs, select = _QUERIES[name]
    parts = [f"{cte} as ({CTES[cte][1].strip()})" for cte in _with(needs)]
    return (f"with {', '.join(parts)} " if parts else "") + select.strip()


ORACLE_SQL: dict[str, str] = {name: sql(name) for name in _QUERIES}
