"""

``entry(spark)`` is the flagship query (the end-to-end slice: raw JSON batches -> staging -> dimension
and fact -> high-water marks) on sf0.001.  ``queries()`` lists one query per operator family of
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart.plans.queries import QUERIES, q_watermark  # noqa: E402

try:  # the training-data operators are an optional part
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL  # noqa: E402
    from corpus_pipeline import run as run_pipeline  # noqa: E402
    from sparkmart.llm.queries import ORACLES as LLM_ORACLES  # noqa: E402
    from sparkmart.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402

    LLM_QUERIES = LLM_QUERIES | {"pipeline": run_pipeline}
    LLM_ORACLES = LLM_ORACLES | ({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})
except ImportError:
    LLM_QUERIES, LLM_ORACLES = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return q_watermark(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | LLM_QUERIES


_RUN_STATUS = """
with t as (
  select cast(user_id as varchar) dag_id, cast(cast(ts as date) as varchar) run_id,
         'e' || cast(event_id as varchar) task_id,
         case event_type when 'error' then 'failed' when 'view' then 'upstream_failed'
                         when 'click' then 'success' when 'purchase' then 'success' end state
  from events),
s as (
  select dag_id, run_id, coalesce(state, 'none') st, count(*) n, min(task_id) first_task
  from t group by 1, 2, 3),
r as (
  select dag_id, run_id, sum(n) n_tasks,
         sum(case when st <> 'success' then n else 0 end) n_bad,
         min(case when st = 'failed' then first_task end) f,
         min(case when st = 'upstream_failed' then first_task end) u,
         min(case when st = 'none' then first_task end) nn,
         '{' || string_agg('''' || st || ''': ' || cast(n as varchar), ', ' order by st) || '}' states
  from s group by 1, 2)
select dag_id, run_id,
       case when f is not null or u is not null then 'FAILED'
            when n_bad = 0 then 'SUCCESS' else 'FAILED' end status,
       case when f is not null then 'FAILED task: ' || f
            when u is not null then 'UPSTREAM_FAILED task: ' || u
            when n_bad = 0 then null
            else 'Incomplete run; states=' || states end error_message,
       coalesce(f, u, nn) culprit_task,
       case when f is not null then 'failed' when u is not null then 'upstream_failed'
            when nn is not null then 'none' end culprit_state,
       cast(n_tasks as bigint) n_tasks
from r
"""

_PAGING = """
select user_id, page, n, event_ids from (
  select *, coalesce(sum(case when n < 50 then 1 else 0 end) over (
              partition by user_id order by page
              rows between unbounded preceding and 1 preceding), 0) short_before
  from (select user_id, page, count(*) n, cast(sum(event_id) as bigint) event_ids
        from (select *, cast(floor((row_number() over (partition by user_id
                                     order by ts desc, event_id desc) - 1) / 50.0) as int) + 1 page
              from events) a
        group by 1, 2) b) c
where short_before = 0 and page <= 10
"""

_RUN_LOG = """
        select 'github_etl' pipeline_name, 'github_etl' dag_id, r.run_id, 'SUCCESS' status,
               cast(null as varchar) error_message,
               r.n * (select count(distinct c_nationkey) from customer) raw_repos_batches,
               r.n * (select count(*) from customer) raw_commits_batches,
               (select count(*) from customer) stg_repos_rows,
               (select count(*) from orders o join customer c on c.c_custkey = o.o_custkey
                where r.run_id = 'run2' or o.o_orderdate < timestamp '1998-01-01') stg_commits_rows,
               (select count(*) from customer) dim_repository_rows,
               (select count(*) from orders o join customer c on c.c_custkey = o.o_custkey
                where r.run_id = 'run2' or o.o_orderdate < timestamp '1998-01-01') fact_commits_rows
        from (values ('run1', 1), ('run2', 2)) r(run_id, n)"""

_ACTIVITY = """
        select c.c_name full_name, date_trunc('month', o.o_orderdate) month_start,
               count(*) n_commits
        from orders o join customer c on c.c_custkey = o.o_custkey group by 1, 2"""

_ORACLES = {
    "json_flatten": "select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem",
    "json_get": "select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events",
    "batch_stats": """
        select c.c_name repo_full_name, cast(1 as bigint) batches, count(*) records
        from orders o join customer c on c.c_custkey = o.o_custkey group by c.c_name""",
    "dedup_latest": """
        select distinct on (user_id) event_id, user_id, ts, event_type from events
        order by user_id, ts desc, event_id desc""",
    "latest_batch": "select user_id, arg_max(event_id, ts) event_id from events group by user_id",
    "topk": """
        select c.c_custkey, m.last_order from customer c left join
          (select o_custkey, max(o_orderdate) last_order from orders
           group by 1) m on m.o_custkey = c.c_custkey
        order by m.last_order desc nulls last, c.c_custkey limit 1200""",
    "paging": _PAGING,
    "paging_cap": """
        select event_type, cast(floor((rn - 1) / 10.0) as int) + 1 page, count(*) n,
               cast(sum(event_id) as bigint) event_ids
        from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) rn
              from events) a
        where rn <= 100 group by 1, 2""",
    "empty_batches": """
        select user_id, cast(1 as bigint) batches,
               count(*) filter (event_type = 'purchase' and ts >= timestamp '2024-01-25 00:00:00') records
        from events group by user_id""",
    "upsert": """
        select coalesce(s.k, t.k) k,
               case when s.k is not null then s.bal else t.bal end bal,
               case when t.k is not null then t.eff else timestamp '2024-02-01 00:00:00' end
                 effective_from
        from (select c_custkey k, c_acctbal bal, timestamp '2024-01-01 00:00:00' eff
              from customer where c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE')) t
        full outer join
             (select c_custkey k, case when c_acctbal >= 0 then c_acctbal + 1 end bal
              from customer where c_mktsegment in ('FURNITURE', 'HOUSEHOLD', 'MACHINERY')) s
        on s.k = t.k""",
    "surrogate_keys": """
        select count(*) n, count(*) n_distinct, cast(1 as bigint) min_key, count(*) max_key
        from orders""",
    "dim_repository": """
        select c.c_custkey repo_id, c.c_name full_name, c.c_name "name", n.n_name owner_login,
               coalesce(case when c.c_acctbal < 0 then true when c.c_acctbal >= 1000 then false end, false)
                 is_private,
               'https://example.com/' || c.c_name html_url, c.c_mktsegment description,
               m.language, case when c.c_acctbal < 0 then 'trunk' else 'main' end default_branch,
               m.created_at, m.pushed_at + interval 1 hour updated_at, m.pushed_at,
               cast(coalesce(m.n, 0) as integer) stargazers_count,
               cast(coalesce(m.n_finished, 0) as integer) forks_count,
               cast(coalesce(m.n - m.n_finished, 0) as integer) open_issues_count, true is_current
        from customer c left join nation n on n.n_nationkey = c.c_nationkey
        left join (select o_custkey, min(o_orderdate) created_at, max(o_orderdate) pushed_at, count(*) n,
                          count(*) filter (o_orderstatus = 'F') n_finished,
                          arg_max(o_orderpriority, (o_orderdate, o_orderkey)) "language" from orders
                   group by o_custkey) m on m.o_custkey = c.c_custkey""",
    "fact_commits": """
        select cast(o.o_orderkey as varchar) sha, o.o_custkey repo_id,
               o.o_orderdate committed_at, o.o_orderstatus author_login,
               c.c_name author_name, o.o_orderpriority commit_message
        from orders o join customer c on c.c_custkey = o.o_custkey""",
    "fact_left_lookup": """
        select cast(o.o_orderkey as varchar) sha, o.o_custkey repo_id,
               o.o_orderdate committed_at, l.additions, l.deletions, l.changed_files
        from orders o join customer c on c.c_custkey = o.o_custkey
        left join (select l_orderkey, cast(floor(sum(l_quantity)) as integer) additions,
                          cast(count(*) as integer) deletions,
                          cast(count(distinct l_partkey) as integer) changed_files
                   from lineitem group by 1) l on l.l_orderkey = o.o_orderkey""",
    "watermark": """
        select c.c_name entity_name, max(o.o_orderdate) watermark_ts
        from orders o join customer c on c.c_custkey = o.o_custkey group by c.c_name""",
    "activity": _ACTIVITY,
    "incremental": """
        with w as (select user_id, max(ts) wm from events
                   where ts < timestamp '2024-01-15 00:00:00' and event_type = 'signup'
                   group by user_id)
        select e.event_id, e.user_id, e.ts from events e left join w on w.user_id = e.user_id
        where e.ts >= coalesce(w.wm, timestamp '2024-01-31 00:00:00' - interval 7 day)""",
    "dq_not_null": """
        select 'dq_fact_repo_id_not_null' check_name,
               case when count(*) = 0 then 1 else 0 end ok, count(*) violations
        from orders o left join (select c_custkey from customer where c_acctbal >= 0) c
          on c.c_custkey = o.o_custkey where c.c_custkey is null""",
    "dq_fk": """
        select 'dq_fact_repo_fk_dim' check_name,
               case when count(*) = 0 then 1 else 0 end ok, count(*) violations
        from orders o left join (select c_custkey from customer where c_acctbal >= 0) c
          on c.c_custkey = o.o_custkey
        where c.c_custkey is null""",
    "dq_watermark": """
        select 'dq_watermark_not_ahead_of_fact' check_name,
               case when count(*) = 0 then 1 else 0 end ok, count(*) violations
        from (select w.n, w.wm, max(f.o_orderdate) mf
              from (select c_name n, max(o_orderdate) wm from orders
                    join customer on c_custkey = o_custkey group by 1) w
              left join customer d on d.c_name = w.n
              left join (select * from orders where o_orderstatus in ('F', 'O')) f
                on f.o_custkey = d.c_custkey
              group by w.n, w.wm) t
        where t.mf is null or t.mf < t.wm""",
    "dq_recent": """
        with a as (select max(ts) as_of from events),
        r as (select count(*) raw_batches from events
              where ts >= (select as_of from a) - interval 30 minute
                and json_array_length('[' || props || ']') > 0),
        g as (select count(*) stg_rows from events
              where event_type <> 'error' and ts >= (select as_of from a) - interval 30 minute)
        select 'dq_last_raw_batches_have_effect' check_name,
               case when (select raw_batches from r) = 0 then 1
                    when (select stg_rows from g) > 0 then 1 else 0 end ok,
               case when (select raw_batches from r) = 0 then 0
                    when (select stg_rows from g) > 0 then 0
                    else (select raw_batches from r) end violations""",
    "dq_recent_fails": """
        with a as (select max(ts) as_of from events)
        select 'dq_last_raw_batches_have_effect' check_name, 0 ok, count(*) violations from events
        where ts >= (select as_of from a) - interval 30 minute
          and json_array_length('[' || props || ']') > 0""",
    "latest_batch_scope": """
        select user_id, arg_max(event_id, ts) event_id from events where event_type = 'click'
        group by user_id""",
    "run_status": _RUN_STATUS,
    "run_status_excluded": _RUN_STATUS.replace(
        "'e' || cast(event_id as varchar) task_id", "event_type task_id").replace(
        "from events)", "from events where event_type <> 'signup')"),
    "lenient_max": """
        select user_id,
               max(try_cast(case when event_type = 'error' then 'junk'
                                 else cast(ts as varchar) end as timestamp)) m
        from events group by user_id""",
    "layer_metrics": """
        select 'customer' tbl, count(*) n from customer
        union all select 'orders', count(*) from orders
        union all select 'lineitem', count(*) from lineitem
        union all select 'events', count(*) from events""",
    "pipeline_run_log": _RUN_LOG,
    "pipeline_delta_run_log": _RUN_LOG,
    "pipeline_delta_scopes": """
        select c_custkey repo_id, c_name full_name, n_name owner_login, true is_current
        from customer join nation on n_nationkey = c_nationkey where n_name in ('NATION_19', 'NATION_11')""",
    "activity_rollup": _ACTIVITY,
    "dq_delta": """
        select 'dq_fact_repo_fk_dim' check_name, case when count(*) = 0 then 1 else 0 end ok,
               count(*) violations
        from orders o left join (select c_custkey from customer where c_acctbal >= 0) c
          on c.c_custkey = o.o_custkey
        where c.c_custkey is null
        union all
        select 'dq_watermark_not_ahead_of_fact', case when count(*) = 0 then 1 else 0 end, count(*)
        from (select m.n, m.wm, max(o.o_orderdate) mf
              from (select c_name n, max(o_orderdate) + interval 1 day wm from orders
                    join customer on c_custkey = o_custkey where o_orderstatus in ('F', 'O') group by 1) m
              left join (select * from customer where c_acctbal >= 0) d on d.c_name = m.n
              left join orders o on o.o_custkey = d.c_custkey group by m.n, m.wm) t
        where t.mf is null or t.mf < t.wm""",
    "upsert_duplicates": """
        select coalesce(c.c_custkey, s.k) k, s.last_order, c.c_acctbal bal
        from customer c full outer join
             (select o_custkey k, arg_max(o_orderkey, (o_orderdate, o_orderkey)) last_order
              from orders group by 1) s on s.k = c.c_custkey""",
    "pipeline_marks": """
        select 'github_commits' pipeline_name, c.c_name entity_name,
               max(o.o_orderdate) watermark_ts
        from orders o join customer c on c.c_custkey = o.o_custkey group by c.c_name""",
    "pipeline_delta_after_failure": """
        select cast(o.o_orderkey as varchar) sha, c.c_name repo_full_name,
               o.o_orderdate committed_at, c.c_custkey repo_id, true in_fact
        from orders o join customer c on c.c_custkey = o.o_custkey
        where o.o_orderdate >= timestamp '1998-07-01 00:00:00' - interval 800 day""",
    "dq_results": """
        select r.run_id, c.check_name, case when bad then 0 else 1 end ok,
               cast(case when bad then 1 else 0 end as bigint) violations,
               case when r.run_id = 'run2' then 'FAILED' else 'SUCCESS' end status,
               case when r.run_id = 'run2' then 'FAILED task: dq_fact_repo_fk_dim' end error_message,
               (select count(*) from orders o join customer c on c.c_custkey = o.o_custkey)
                 + case when r.run_id = 'run2' then 1 else 0 end fact_commits_rows
        from (values ('run1'), ('run2')) r(run_id),
             (values ('dq_fact_repo_id_not_null'), ('dq_fact_repo_fk_dim'),
                     ('dq_watermark_not_ahead_of_fact'), ('dq_last_raw_batches_have_effect'))
               c(check_name),
             lateral (select r.run_id = 'run2' and c.check_name = 'dq_fact_repo_fk_dim' bad) b""",
    "constraint_defaults": """
        select o_orderpriority pipeline_name, o_orderstatus dag_id, cast(o_orderkey as varchar) run_id,
               'RUNNING' status, timestamp '2024-02-01 00:00:00' start_ts from orders""",
    "pack_chunks": """
        select distinct on (l_returnflag, l_partkey) l_returnflag, l_partkey, l_orderkey, l_linenumber
        from lineitem order by l_returnflag, l_partkey, l_orderkey desc, l_linenumber desc""",
    "stream_marks": """
        select c.c_name entity_name, max(o.o_orderdate) watermark_ts
        from orders o join customer c on c.c_custkey = o.o_custkey group by c.c_name""",
    "stream_staging": """
        select cast(o.o_orderkey as varchar) sha, c.c_name repo_full_name,
               o.o_orderdate committed_at, o.o_orderpriority commit_message
        from orders o join customer c on c.c_custkey = o.o_custkey""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query name over the pre-registered driver tables."""
    return {k: v for k, v in _ORACLES.items() if k in QUERIES} | LLM_ORACLES
