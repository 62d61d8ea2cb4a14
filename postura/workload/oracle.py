"""Reference answers: for each registered query, plain SQL over the given tables."""

from __future__ import annotations

import re

# Named building blocks; a block may use those above it.
BLOCKS: dict[str, str] = {
    "f_hosts": "select cast(c_custkey as string) as device_id, c_name as hostname from customer",
    "f_vulns": """
        select cast(o_custkey as string) as aid,
          case o_orderstatus when 'O' then 'open' when 'P' then 'reopen' else 'closed' end as status,
          case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'HIGH'
                               when '3-MEDIUM' then 'MEDIUM' when '5-LOW' then 'LOW' end as severity,
          case o_orderkey % 3 when 0 then 'O' when 1 then 'U' end as remediation_level,
          case when o_orderkey % 4 < 3 then cast((o_orderkey % 4) * 30 as int) end as exploit_status,
          case when o_orderkey % 11 = 0 then '' else concat('CVE-', cast(o_orderkey as string)) end as cve_id,
          cast(o_orderdate as date) as published_date,
          cast(o_orderdate as date) as created_timestamp
        from orders""",
    "f_users": """
        select c.c_name as login,
          case when c.c_nationkey % 5 = 0 then 'SUSPENDED' else 'ACTIVE' end as status,
          o.last_login, o.first_login as password_changed
        from customer c
        left join (select o_custkey, max(cast(o_orderdate as date)) as last_login,
                          min(cast(o_orderdate as date)) as first_login
                   from orders group by o_custkey) o on o.o_custkey = c.c_custkey""",
    "f_enroll": """
        select c.c_name as email, cast(o.o_orderdate as date) as completion_date
        from orders o join customer c on c.c_custkey = o.o_custkey where o.o_orderpriority = '5-LOW'""",
    "f_projects": "select p_partkey as id, p_name as name, p_type as target_file from part",
    "f_issues": """
        select l_partkey as project_id,
          case l_linestatus when 'O' then 'open' else 'resolved' end as status,
          case when l_quantity >= 49 then 'critical' when l_quantity >= 47 then 'high'
               when l_quantity >= 25 then 'medium' else 'low' end as severity
        from lineitem""",
    "f_assets": """
        select c_name as resource, 'host' as resource_type, r_name as business_unit, n_name as team,
          c_mktsegment as location
        from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
        where c_custkey % 10 <> 0""",
    "f_lib": """
        select metric_id, title, category, cast(slo as double) as slo,
          cast(slo_min as double) as slo_min, cast(weight as double) as weight
        from (values
          ('economy','Economy','Vulnerability Management',0.68,0.66,0.2),
          ('large','Large','Vulnerability Management',0.66,0.60,0.8),
          ('medium','Medium','Identity Management',0.67,0.665,0.8),
          ('promo','Promo','Identity Management',0.70,0.65,0.4),
          ('small','Small','User Security',0.75,0.70,0.4),
          ('standard','Standard','Software Development',0.65,0.60,0.8)
        ) as t(metric_id, title, category, slo, slo_min, weight)""",
    "f_detail": """
        select cast(l_shipdate as date) as datestamp, lib.metric_id, lib.title, lib.category, lib.slo,
          lib.slo_min, lib.weight, r_name as business_unit, n_name as team, c_mktsegment as location,
          concat('line-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as resource,
          'line' as resource_type, p_name as detail,
          case when l_returnflag = 'R' then 0.0e0 else 1.0e0 end as compliance
        from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
        join part on p_partkey = l_partkey join f_lib lib on lib.metric_id = lower(p_type)""",
    "f_summary": """
        select datestamp, metric_id, title, category, slo, slo_min, weight, business_unit, team, location,
          sum(compliance) as totalok, count(compliance) as total
        from f_detail group by all""",
    "f_run_detail": """
        select * from f_detail where datestamp between date '2001-07-01' and date '2001-07-31'
        and metric_id in ('economy','large','small')""",
    "f_old_summary": "select * replace (total + 1 as total) from f_summary",
    "f_old_detail": "select * from f_detail",
    "f_nulls": """
        select event_id, event_type,
          case when user_id % 7 = 0 then null when user_id % 7 = 1 then ''
               else concat('u', cast(user_id % 7 as string)) end as dim,
          case when event_id % 5 = 0 then null else value end as measure
        from events""",
    "f_uploads": """
        select event_type as tag, case when user_id % 4 <> 3 then concat('t', cast(user_id % 4 as string)) end as tenancy,
          cast(ts as date) as upload_date, event_id, value
        from events""",
    # --- shipped metrics -----------------------------------------------------------------
    "m_lib": """
        select metric_id, title, category, cast(slo as double) as slo,
          cast(slo_min as double) as slo_min, cast(weight as double) as weight
        from (values
          ('development_vulnerabilities','Software repositories without critical vulnerabilities','Software Development',0.99,0.98,0.8),
          ('identity_credentials','Identity - Aged Credentials','Identity Management',0.99,0.98,0.8),
          ('identity_dormant','Identity - Inactive Identities','Identity Management',0.99,0.98,0.8),
          ('user_awareness','Users with awareness training completed','User Security',0.90,0.80,0.4),
          ('vulnerabilities_critical','Systems without Critical and High vulnerabilities','Vulnerability Management',0.95,0.80,0.2),
          ('vulnerabilities_critical_patching','Critical vulnerabilities patched within SLO','Vulnerability Management',0.95,0.80,0.2),
          ('vulnerabilities_explot_patchable','Systems without exploitable vulnerabilities','Vulnerability Management',0.95,0.80,0.8)
        ) as t(metric_id, title, category, slo, slo_min, weight)""",
    "m_development_vulnerabilities": """
        select name as resource, 'snyk' as resource_type,
          case when project_id is not null then 1.0e0 else 0.0e0 end as compliance, target_file as detail
        from f_projects left join f_issues on id = project_id and f_issues.status = 'open'
          and severity in ('critical','high')""",
    "m_identity_dormant": """
        select login as resource, 'user' as resource_type,
          case when date_diff('day', last_login, date '2001-08-02') < 90 then 1.0e0 else 0.0e0 end as compliance,
          cast(last_login as string) as detail
        from f_users where status = 'ACTIVE'""",
    "m_identity_credentials": """
        select login as resource, 'user' as resource_type,
          case when date_diff('day', password_changed, date '2001-08-02') < 90 then 1.0e0 else 0.0e0 end
            as compliance,
          cast(password_changed as string) as detail
        from f_users where status = 'ACTIVE'""",
    "m_user_awareness": """
        select login as resource, 'user' as resource_type,
          case when email is not null then 1.0e0 else 0.0e0 end as compliance, login as detail
        from f_users left join f_enroll on login = email
          and date_diff('day', completion_date, date '2001-08-02') <= 365
        where status = 'ACTIVE'""",
    "m_vulnerabilities_critical": """
        select hostname as resource, 'host' as resource_type,
          case when aid is null then 1.0e0 else 0.0e0 end as compliance, '' as detail
        from f_hosts left join f_vulns on device_id = aid and severity in ('HIGH','CRITICAL')
          and status in ('open','reopen')""",
    "m_vulnerabilities_critical_patching": """
        select hostname as resource, 'host' as resource_type,
          case when aid is null then 1.0e0 else 0.0e0 end as compliance, '' as detail
        from f_hosts left join f_vulns on device_id = aid and severity in ('HIGH','CRITICAL')
          and status in ('open','reopen')
          and published_date < date '2001-08-02' - interval 14 day
          and created_timestamp < date '2001-08-02' - interval 30 day""",
    "m_vulnerabilities_explot_patchable": """
        select hostname as resource, 'host' as resource_type,
          case when aid is null then 1.0e0 else 0.0e0 end as compliance, '' as detail
        from f_hosts left join f_vulns on device_id = aid and status in ('open','reopen')
          and coalesce(remediation_level = 'O', false) and coalesce(exploit_status > 0, false)""",
    "m_results": """
        select 'development_vulnerabilities' as metric_id, * from m_development_vulnerabilities
        union all select 'identity_credentials', * from m_identity_credentials
        union all select 'identity_dormant', * from m_identity_dormant
        union all select 'user_awareness', * from m_user_awareness
        union all select 'vulnerabilities_critical', * from m_vulnerabilities_critical
        union all select 'vulnerabilities_critical_patching', * from m_vulnerabilities_critical_patching
        union all select 'vulnerabilities_explot_patchable', * from m_vulnerabilities_explot_patchable""",
    "m_detail": """
        select date '2001-08-02' as datestamp, metric_id, title, category, slo, slo_min, weight,
          coalesce(business_unit, 'undefined') as business_unit, coalesce(team, 'undefined') as team,
          coalesce(location, 'undefined') as location, resource, resource_type, detail, compliance
        from m_results join m_lib using (metric_id) left join f_assets using (resource, resource_type)""",
    "m_summary": """
        select datestamp, metric_id, title, category, slo, slo_min, weight, business_unit, team, location,
          sum(compliance) as totalok, count(compliance) as total
        from m_detail group by all""",
    # --- sampled summary -----------------------------------------------------------------
    "date_ranks": """
        select datestamp, row_number() over (order by datestamp) as row_num, count(*) over () as total_rows
        from (select distinct datestamp from f_summary
              where datestamp >= date '2001-11-04' - interval 1 year)""",
    "date_candidates": """
        select datestamp from date_ranks
        where row_num = total_rows or row_num = 1 or row_num % ceil(total_rows / 12.0) = 0""",
    "v_summary": """
        select s.* from f_summary s
        join (select datestamp from date_candidates order by datestamp limit 12) d using (datestamp)""",
    # --- scores ---------------------------------------------------------------------------
    "trend": """
        select datestamp, sum(weighted) / sum(weight) as score, avg(slo) as slo, avg(slo_min) as slo_min
        from (select metric_id, datestamp, weight, sum(totalok) / sum(total) * weight as weighted,
                avg(slo) as slo, avg(slo_min) as slo_min
              from v_summary group by metric_id, datestamp, weight)
        group by datestamp""",
    "categories": """
        select category, sum(weighted) / sum(weight) as score, avg(slo) as slo, avg(slo_min) as slo_min
        from (select metric_id, category, weight, sum(totalok) / sum(total) * weight as weighted,
                avg(slo) as slo, avg(slo_min) as slo_min
              from v_summary where datestamp = (select max(datestamp) from v_summary)
              group by metric_id, category, weight)
        group by category""",
    "metric_days": """
        select datestamp, metric_id, max(title) as title, sum(totalok) as totalok, sum(total) as total,
          sum(totalok) / sum(total) as score, max(slo) as slo, max(slo_min) as slo_min
        from f_summary group by datestamp, metric_id""",
    "cards": """
        select datestamp, category, title, metric_id, cast(sum(total) as double) as sum_total,
          sum(totalok) as sum_totalok, avg(weight) as weight, avg(slo) as slo, avg(slo_min) as slo_min,
          sum(totalok) / sum(total) as score
        from f_summary s
        where datestamp = (select max(datestamp) from f_summary m where m.title = s.title)
        group by datestamp, category, title, metric_id""",
    "alerts": """
        select datestamp, metric_id, title, category, slo, slo_min, sum(compliance) as totalok,
          count(compliance) as total, sum(compliance) / count(compliance) as score,
          count(compliance) - sum(compliance) as failed,
          case when sum(compliance) / count(compliance) >= slo then '🟢'
               when sum(compliance) / count(compliance) >= slo_min then '🟡' else '🔴' end as icon
        from f_detail group by datestamp, metric_id, title, category, slo, slo_min""",
    "lines": """
        select *, concat(icon, ' ', title, ' - ', cast(cast(round_even(score * 100, 0) as bigint) as string),
          '% (', cast(cast(failed as bigint) as string), ')') as line
        from alerts""",
}


def weighted(dim: str | None, where: str = "true") -> str:
    """The dashboard score by date and one dimension."""
    d = f", coalesce(nullif({dim}, ''), 'None') as {dim}" if dim else ""
    g = f", {dim}" if dim else ""
    return f"""
        select datestamp{g}, sum(score * weight) / sum(weight) as value, avg(slo) as slo,
          avg(slo_min) as slo_min
        from (select datestamp{d}, metric_id as m, sum(totalok) / sum(total) as score,
                max(weight) as weight, max(slo) as slo, max(slo_min) as slo_min
              from f_summary where {where} group by all)
        group by all"""


BLOCKS["by_date"] = weighted(None)
BLOCKS["by_unit"] = weighted("business_unit")
BLOCKS["by_category"] = weighted("category")
BLOCKS["by_metric"] = weighted("metric_id")
BLOCKS["by_one_metric"] = weighted("category", "metric_id = 'economy'")


# Fixed value: the run date that the blocks name.
RUN_DATE = "2001-08-02"


def on_days(body: str, *days: str) -> str:
    """The rows of ``body`` for runs of several days."""
    return "\nunion all\n".join(f"select * from ({statement(body).replace(RUN_DATE, day)})" for day in days)


def statement(body: str) -> str:
    """``body`` preceded by the blocks it needs, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(BLOCKS[name])
    ctes = ",\n".join(f"{name} as ({BLOCKS[name]})" for name in BLOCKS if name in needed)
    return f"with {ctes}\n{body}" if ctes else body
