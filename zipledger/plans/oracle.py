"""DuckDB SQL for every registered query, over the same parquet tables.

Each text starts from the same adapters as ``sources/adapters.py``.
"""

from __future__ import annotations

from . import params as P

MANIFEST = """
select cast(o_orderkey as string) as archive_id, o_orderdate as archive_time,
 case when o_orderkey % 17 = 0 then '10.0.0.1:org' || cast(o_custkey % 5 as string)
      when o_orderkey % 19 = 0 then ''
      when o_orderkey % 23 = 0 then cast(null as string)
      else '10.0.0.' || cast(o_orderkey % 4 as string) || ':org' || cast(o_custkey % 5 as string)
           || ':' || o_orderstatus || '.example:' || cast(cast(o_orderdate as date) as string)
           || ':' || cast(o_orderkey as string) end as archive_location,
 cast(floor(o_totalprice) as bigint) as raw_eml_size,
 case o_orderkey % 10 when 0 then cast(null as string) when 1 then '' when 2 then '  '
      when 3 then '""' when 4 then 'PENDING' when 5 then 'PROCESSING' when 6 then 'COMPLETED'
      when 7 then 'FAILED' when 8 then 'pending' else 'PENDING' end as export_status,
 o_orderdate as updated_at, cast(null as string) as error_log, cast(0 as int) as retries
from orders
"""

NOW = f"timestamp '{P.NOW}'"

CURRENT = f"""
select archive_id, archive_time, archive_location, raw_eml_size,
  case when export_status = 'PROCESSING' then 'PENDING' else export_status end as export_status,
  case when export_status = 'PROCESSING' then {NOW} else updated_at end as updated_at,
  error_log, retries
from m
"""

ELIGIBLE = """(export_status is null or trim(export_status, ' ') = '' or export_status = '""'
  or export_status = 'PENDING')"""

PARSED = """
select *, coalesce(length(archive_location) - length(replace(archive_location, ':', '')) = 4, false) as valid
from {src}
"""

def _fields(alias: str = "") -> str:
    names = ["server_ip", "org_id", "domain", '"date"', '"id"']
    return ", ".join(f"case when {alias}valid then split_part({alias}archive_location, ':', {i + 1}) end as {n}"
                     for i, n in enumerate(names))


def _with(*ctes: tuple[str, str], recursive: bool = False) -> str:
    base = [("m", MANIFEST), ("cur", CURRENT)]
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{n} as ({sql})" for n, sql in base + list(ctes)) + "\n"


CLAIMED = f"""
select archive_id, archive_time, archive_location, raw_eml_size,
  row_number() over (order by archive_time asc nulls first, archive_id) as claim_seq
from cur where {ELIGIBLE}
"""


ATTEMPTS = """
select archive_id, attempt,
 case when (cast(archive_id as bigint)*7 + attempt*3) % 5 < 1 then 200
      when (cast(archive_id as bigint)*7 + attempt*3) % 5 < 3 then 503
      when (cast(archive_id as bigint) + attempt) % 5 = 4 then 204
      else cast(null as int) end as http_status
from m, (select unnest([1, 2, 3]) as attempt) t
"""

ATTEMPTS_E = "select *, case when http_status is null then 'timeout' end as error from att0"

FOLD = """
select f.archive_id, f.first_ok is not null as fetch_ok,
  cast(coalesce(f.first_ok, f.last_attempt) as int) as attempts_used,
  cast(case when f.first_ok is not null then 200 else l.http_status end as int) as http_status,
  case when f.first_ok is not null then null else l.error end as fetch_error
from (select archive_id, min(case when http_status = 200 then attempt end) as first_ok,
             max(attempt) as last_attempt from att where attempt between 1 and 3 group by archive_id) f
join (select archive_id, http_status, error from
        (select *, row_number() over (partition by archive_id order by attempt desc) as rn
         from att where attempt between 1 and 3) where rn = 1) l using (archive_id)
"""

REASON = """case when fetch_ok then null
  when http_status is not null then printf('API returned status %d after %d attempts', http_status, 3)
  else printf('Network error after %d attempts: %s', 3, fetch_error) end"""

REJECTS = f"""
select archive_id, 'FAILED' as export_status, 'Parse error: invalid archive location format' as error_log
from (select *, coalesce(length(archive_location) - length(replace(archive_location, ':', '')) = 4, false) as valid
      from cur where {ELIGIBLE}) where not valid
"""

EVENTS_DONE = "select cast(event_id as string) as archive_id, ts from events"


def _fmt2(x: str) -> str:
    return f"printf('%.2f', {x})"


def format_size_sql(b: str) -> str:
    parts = [f"case when {b} < 1024 then cast({b} as varchar) || ' B'"]
    for i, p in enumerate("KMGTPE"):
        div = 1024 ** (i + 1)
        text = f"{_fmt2(f'cast({b} as double) / {div}.0::double')} || ' {p}B'"
        if p == "E":
            parts.append(f"else {text} end")
        else:
            parts.append(f"when {b} < {1024 ** (i + 2)} then {text}")
    return "\n ".join(parts)


def _apply(updates_cte: str) -> str:
    return f"""
select c.archive_id, c.archive_time, c.archive_location, c.raw_eml_size,
  case when u.archive_id is not null then u.export_status else c.export_status end as export_status,
  case when u.archive_id is not null then {NOW} else c.updated_at end as updated_at,
  case when u.archive_id is not null then u.error_log else c.error_log end as error_log,
  c.retries
from cur c left join (
  select archive_id, export_status, error_log from (
    select *, row_number() over (partition by archive_id
      order by seq desc, export_status desc nulls last, error_log desc nulls last) as rn
    from {updates_cte}) where rn = 1) u using (archive_id)
"""


VALID = "coalesce(length(archive_location) - length(replace(archive_location, ':', '')) = 4, false)"

PACKIN = f"""
select c.archive_id, cast((c.claim_seq - 1) % {P.SLOTS} as int) as slot, c.claim_seq,
  split_part(c.archive_location, ':', 2) as org_id, c.raw_eml_size as declared,
  coalesce(d.stored, c.raw_eml_size) as actual
from c left join (select cast(doc_id as string) as archive_id, cast(strlen(text) as bigint) as stored
                  from documents) d using (archive_id)
where {VALID.replace('archive_location', 'c.archive_location')}
"""

CAP = P.PACK_CAP_MB * 1024 * 1024


def _pack_ctes(keys: list[str], rotate: bool) -> list[tuple[str, str]]:
    kc = ", ".join(keys)
    bk = ", ".join(f"b.{k}" for k in keys)
    on = " and ".join(f"b.{k} = w.{k}" for k in keys)
    new = (f"b.org_id <> w.cur_grp or " if rotate else "") + f"w.fill + b.declared > {CAP}"
    base = f"select *, row_number() over (partition by {kc} order by claim_seq) as i from packin"
    walk = f"""
select {kc}, i, archive_id, cast(1 as bigint) as k, actual as fill, org_id as cur_grp from base where i = 1
union all
select {bk}, b.i, b.archive_id, case when {new} then w.k + 1 else w.k end,
  case when {new} then b.actual else w.fill + b.actual end, b.org_id
from walk w join base b on {on} and b.i = w.i + 1
"""
    return [("c", CLAIMED), ("packin", PACKIN), ("base", base), ("walk", walk)]


PACKED_SELECT = """
select p.archive_id, p.slot, p.claim_seq, p.declared, p.actual{extra}, w.k
from packin p join walk w using (archive_id)
"""

NUMBERED = f"""
select w.archive_id, w.slot, w.k, o.off0
from walk w join (
  select slot, cast({P.RESUME_START} + coalesce(sum(kmax) over (order by slot
         rows between unbounded preceding and 1 preceding), 0) as bigint) as off0
  from (select slot, max(k) as kmax from walk group by slot)) o using (slot)
"""

ARCHIVE_NAMES = f"""
select 'job' || cast(event_id % 3000 as string) as job,
  case when event_id % 3000 % 13 = 0 then 1 else 0 end as depth,
  case event_id % 9
    when 0 then 'emails_' || lpad(cast(event_id as string), 4, '0') || '.zip'
    when 1 then 'emails_' || cast(event_id as string) || '.zip.tmp'
    when 2 then 'emails_' || cast(event_id as string) || '.ZIP'
    when 3 then 'emails_' || cast(event_id as string) || '.tar'
    when 4 then 'emails_' || cast(event_id as string) || '00000000.zip'
    when 5 then 'emails_x.zip'
    when 6 then 'emails_-' || cast(event_id as string) || '.zip'
    when 7 then 'f' || cast(event_id as string) || '.zip'
    else 'emails_' || cast(event_id as string) || '.zip' end as name
from events
"""


INVENTORY = """
select 'job' || cast(event_id % 3000 as string) as job,
 case when event_id % 3000 % 13 = 0 then 1 else 0 end as depth,
 '/storage/job' || cast(event_id % 3000 as string)
   || case when event_id % 3000 % 13 = 0 then '/sub' else '' end || '/f' || cast(event_id as string)
   || case event_id % 3000 % 6 when 0 then '.zip' when 1 then '.db' when 2 then '.ZIP'
      when 3 then '.log' when 4 then '' else '.zip' end as path,
 cast(ts as timestamp) as mtime, cast(floor(abs(value) * 1000000) as bigint) as length
from events
"""

RET_NOW = f"timestamp '{P.RETENTION_NOW}'"

PLAN = f"""
select path, length, mtime,
  cast(floor(epoch_us({RET_NOW} - mtime) / 86400000000) as bigint) as age_days
from inv
where regexp_extract(path, '([.][^./]*)$', 1) in ('.zip', '.db')
  and mtime < {RET_NOW} - interval {P.MAX_AGE_DAYS * 24} hours
"""

SUMMARY = """
select count(*) as files, cast(coalesce(sum(length), 0) as bigint) as bytes,
  printf('%.2f', cast(coalesce(sum(length), 0) as double) / 1073741824.0::double) as gb_freed,
  cast(0 as bigint) as errors
from plan
"""

EMPTY_DIRS = """
select '/storage/' || job as path from inv group by job
having bool_and(depth = 0 and path in (select path from plan))
"""

CONTENT = "select cast(doc_id as string) as archive_id, text from documents"

EXPORT_LEDGER = f"""
select c.archive_id, c.archive_time, c.archive_location, c.raw_eml_size,
  case when e.archive_id is null then c.export_status
       when not e.valid then 'FAILED'
       when d.archive_id is not null then 'COMPLETED' else 'FAILED' end as export_status,
  case when e.archive_id is null then c.updated_at else {NOW} end as updated_at,
  case when e.archive_id is null then c.error_log
       when not e.valid then 'Parse error: invalid archive location format'
       when d.archive_id is not null then null else 'API returned status 404 after 3 attempts' end as error_log,
  c.retries
from cur c
left join (select archive_id, {VALID} as valid from cur where {ELIGIBLE}) e using (archive_id)
left join (select cast(doc_id as string) as archive_id from documents) d using (archive_id)
"""

SINK_PACKIN = f"""
select c.archive_id, cast((c.claim_seq - 1) % {P.SLOTS} as int) as slot, c.claim_seq,
  split_part(c.archive_location, ':', 2) as org_id, c.raw_eml_size as declared,
  cast(strlen(d.text) as bigint) as actual
from c join ({CONTENT}) d using (archive_id)
where {VALID.replace('archive_location', 'c.archive_location')}
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["manifest_scan"] = _with() + "select * from m"
    q["eligible_records"] = _with() + f"""
select archive_id, archive_time, archive_location, raw_eml_size from m where {ELIGIBLE}"""
    q["parse_location"] = _with(("p", PARSED.format(src="m"))) + f"""
select archive_id, archive_location, valid, {_fields()} from p"""
    q["build_url"] = _with(("p", PARSED.format(src="m"))) + """
select archive_id, 'http://' || split_part(archive_location, ':', 1) || ':8686/archive/read/'
  || split_part(archive_location, ':', 2) || '/' || split_part(archive_location, ':', 3) || '/'
  || split_part(archive_location, ':', 4) || '/' || split_part(archive_location, ':', 5) as url
from p where valid"""
    q["reset_stale"] = _with() + "select * from cur"
    q["progress_stats"] = _with() + """
select cast(count_if(export_status = 'COMPLETED') as bigint) as completed,
  cast(count_if(export_status = 'FAILED') as bigint) as failed, count(*) as total from m"""
    q["claim_batches"] = _with(("c", CLAIMED)) + f"""
select *, cast(floor((claim_seq - 1) / {P.BATCH_SIZE}) as bigint) as batch_id from c"""
    q["claim_first_batch"] = _with(("c", CLAIMED)) + f"""
select archive_id, archive_time, archive_location, raw_eml_size from c where claim_seq <= {P.BATCH_SIZE}"""
    att = [("att0", ATTEMPTS), ("att", ATTEMPTS_E), ("fold", FOLD)]
    q["parse_rejects"] = _with(("r", REJECTS)) + "select * from r"
    q["claim_mark_processing"] = _with(("c", CLAIMED)) + f"""
select u.archive_id, u.archive_time, u.archive_location, u.raw_eml_size,
  case when c.claim_seq <= {P.BATCH_SIZE} then 'PROCESSING' else u.export_status end as export_status,
  case when c.claim_seq <= {P.BATCH_SIZE} then {NOW} else u.updated_at end as updated_at,
  u.error_log, u.retries
from cur u left join c using (archive_id)"""
    q["fold_attempts"] = _with(*att) + "select * from fold"
    q["failure_reasons"] = _with(*att) + f"select archive_id, {REASON} as error_log from fold where not fetch_ok"
    q["backoff_seconds"] = _with(*att) + """
select archive_id, attempts_used,
  cast(case when attempts_used <= 1 then 0
       else (attempts_used - 1) * attempts_used * (2 * attempts_used - 1) / 6 end as bigint) as backoff_seconds
from fold"""
    q["format_size"] = _with(("s", """select archive_id,
  raw_eml_size * cast(pow(1024, cast(archive_id as bigint) % 5) as bigint) as nbytes from m""")) + f"""
select archive_id, nbytes, {format_size_sql('nbytes')} as size_text from s"""
    q["portal_link"] = _with(("p", PARSED.format(src="m"))) + """
select archive_id, base_url, rtrim(base_url, '/') || '/' || job as link from (
  select archive_id, 'https://' || split_part(archive_location, ':', 1) || '/portal'
    || repeat('/', cast(cast(archive_id as bigint) % 4 as int)) as base_url,
    'job-' || split_part(archive_location, ':', 2) as job
  from p where valid)"""
    q["slot_sizing"] = """
select archive_id, workers, zip_slots, max_zip_mb,
  greatest(case when zip_slots <= 0 then greatest(workers // 5, 5) else zip_slots end, 1) as slots,
  case when max_zip_mb > 0 then max_zip_mb * 1048576 else 9223372036854775807 end as cap_bytes
from (select cast(o_orderkey as string) as archive_id, o_custkey % 300 as workers,
        o_orderkey % 9 - 3 as zip_slots, o_orderkey % 5 - 1 as max_zip_mb from orders)"""
    q["mark_completed"] = _with(("d", EVENTS_DONE), ("u", """
select archive_id, 'COMPLETED' as export_status, cast(null as varchar) as error_log, 0 as seq from d""")) \
        + _apply("u")
    q["mark_failed"] = _with(("r", REJECTS), ("u", "select *, 0 as seq from r")) + _apply("u")
    q["apply_updates"] = _with(("r", REJECTS), *att, ("v", f"""
select archive_id from cur where {ELIGIBLE}
  and coalesce(length(archive_location) - length(replace(archive_location, ':', '')) = 4, false)"""),
        ("d", EVENTS_DONE), ("u", f"""
select archive_id, export_status, error_log, 1 as seq from r
union all
select archive_id, case when fetch_ok then 'COMPLETED' else 'FAILED' end, {REASON}, 2
from fold where archive_id in (select archive_id from v)
union all
select archive_id, 'COMPLETED', null, 3 from d""")) + _apply("u")
    q["slot_assignment"] = _with(("c", CLAIMED)) + f"""
select archive_id, claim_seq, cast((claim_seq - 1) % {P.SLOTS} as int) as slot from c"""
    q["pack_next_fit"] = _with(*_pack_ctes(["slot"], False), recursive=True) + PACKED_SELECT.format(extra="")
    one = _pack_ctes(["slot"], False)
    one[1] = ("packin", PACKIN.replace(f"(c.claim_seq - 1) % {P.SLOTS}", "0"))
    q["pack_one_slot"] = _with(*one, recursive=True) + PACKED_SELECT.format(extra="")
    q["pack_by_org"] = _with(*_pack_ctes(["org_id", "slot"], False), recursive=True) \
        + PACKED_SELECT.format(extra=", p.org_id")
    q["pack_rotate_on_change"] = _with(*_pack_ctes(["slot"], True), recursive=True) \
        + PACKED_SELECT.format(extra=", p.org_id")
    numbered = _with(*_pack_ctes(["slot"], False), ("nb0", NUMBERED), recursive=True)
    q["number_archives"] = numbered + """
select n.archive_id, n.slot, n.k, cast(n.off0 + n.k as bigint) as zip_idx from nb0 n"""
    q["archive_names"] = numbered + """
select distinct cast(off0 + k as bigint) as zip_idx, printf('emails_%04d.zip', cast(off0 + k as bigint)) as archive_name
from nb0"""
    q["archive_entries"] = numbered + f"""
select archive_id, cast(off0 + k as bigint) as zip_idx, archive_id || '.eml' as entry_name,
  printf('emails_%04d.zip', cast(off0 + k as bigint)) as archive_name,
  '{P.JOB_ID}/' || printf('emails_%04d.zip', cast(off0 + k as bigint)) as archive_path
from nb0"""
    q["resume_index"] = f"""
with n as ({ARCHIVE_NAMES})
select job, cast(coalesce(greatest(max(case when depth = 0 then try_cast(nullif(
  regexp_extract(name, '^emails_[ \t]*([+-]?[0-9]+)[.]zip', 1), '') as int) end), 0), 0) as int) as resume_index
from n group by job"""
    q["running_progress"] = _with(("d", EVENTS_DONE), ("s", """
select count_if(export_status = 'COMPLETED') as done, count(*) as total from cur""")) + """
select archive_id, ts, cast(s.done + row_number() over (order by ts nulls first, archive_id) as bigint) as progress_n,
  cast(s.done + row_number() over (order by ts nulls first, archive_id) as varchar) || '/' || cast(s.total as varchar)
    as progress
from d, s"""
    q["flush_batches"] = f"""
with d as ({EVENTS_DONE}),
t as (select *, cast(floor(epoch_us(ts - timestamp '{P.FLUSH_START}') / {P.FLUSH_INTERVAL_SECONDS * 1_000_000})
      as bigint) as tick from d)
select archive_id, ts, tick,
  cast(floor((row_number() over (partition by tick order by ts nulls first, archive_id) - 1) / {P.FLUSH_BATCH})
       as bigint) as flush_batch
from t"""
    q["fetch_content"] = _with(*att, ("c", CLAIMED)) + f"""
select * from fold where archive_id in (select archive_id from c where {VALID})"""
    q["resolve_content"] = _with(("c", CLAIMED)) + f"""
select c.archive_id, d.archive_id is not null as fetch_ok,
  cast(case when d.archive_id is not null then 1 else 3 end as int) as attempts_used,
  cast(case when d.archive_id is not null then 200 else 404 end as int) as http_status,
  cast(strlen(d.text) as bigint) as content_bytes, md5(d.text) as content_md5
from c left join ({CONTENT}) d using (archive_id) where {VALID.replace('archive_location', 'c.archive_location')}"""
    sink = _pack_ctes(["slot"], False)
    sink[1] = ("packin", SINK_PACKIN)
    sink = [(n, sql.replace(str(CAP), str(P.SINK_CAP_BYTES))) for n, sql in sink]
    q["archive_sink"] = _with(*sink, ("nb0", NUMBERED.replace(str(P.RESUME_START), "0")), recursive=True) + f"""
select cast(n.off0 + n.k as bigint) as zip_idx,
  '{P.JOB_ID}/' || printf('emails_%04d.zip', cast(n.off0 + n.k as bigint)) as archive_path,
  count(*) as entries, cast(sum(p.actual) as bigint) as bytes
from nb0 n join packin p using (archive_id) group by all"""
    q["export_job"] = _with(("x", EXPORT_LEDGER)) + "select * from x"
    q["export_roundtrip"] = _with(("c", CLAIMED)) + f"""
select c.archive_id, cast(1 as bigint) as n_archives, cast(strlen(d.text) as bigint) as content_bytes, md5(d.text) as content_md5
from c join ({CONTENT}) d using (archive_id) where {VALID.replace('archive_location', 'c.archive_location')}"""
    q["export_by_org"] = _with(("c", CLAIMED)) + f"""
select x.*, '{P.JOB_ID}/' || split_part(archive_location, ':', 2) as folder
from ({q['export_roundtrip']}) x join c using (archive_id)"""
    q["archive_commit"] = q["archive_sink"]
    q["slots_by_bytes"] = _with(("c", CLAIMED)) + f"""
select archive_id, claim_seq, cast(least((upto - raw_eml_size) * {P.SLOTS} // total, {P.SLOTS - 1}) as int) as slot
from (select *, sum(raw_eml_size) over (order by claim_seq) as upto, sum(raw_eml_size) over () as total from c)"""
    q["stream_ledger_changes"] = _with(("c", CLAIMED)) + f"""
select u.archive_id, cast(count(claim_seq) + count(*) filter (claim_seq <= {P.BATCH_SIZE})
  + count(*) filter (export_status = 'FAILED' and cast(u.archive_id as bigint) % 4 = 1) as bigint) as n_times
from cur u left join c using (archive_id) group by u.archive_id having n_times > 0"""
    q["reconcile_archives"] = _with(*sink, ("nb0", NUMBERED.replace(str(P.RESUME_START), "0")), recursive=True) + f"""
select archive_id, case when idx = {P.SET_BACK} then 'PENDING' else 'COMPLETED' end as export_status,
  cast(case idx when {P.LOST} then 0 when {P.COPIED} then 2 else 1 end as bigint) as n_archives,
  case idx when {P.LOST} then 'missing' when {P.COPIED} then 'duplicate' when {P.SET_BACK} then 'orphan' else 'ok' end as finding
from (select archive_id, off0 + k as idx from nb0)"""
    q["archive_chunks"] = f"select *, content_bytes as listed_bytes from ({q['export_roundtrip']})"
    q["resume_run"] = q["export_job"]
    q["export_job_fetch"] = _with(*att, ("e", f"select archive_id, {VALID} as valid from cur where {ELIGIBLE}"),
                                  ("o", f"select archive_id, fetch_ok, {REASON} as reason from fold")) + f"""
select c.archive_id, c.archive_time, c.archive_location, c.raw_eml_size,
  case when e.archive_id is null then c.export_status when not e.valid then 'FAILED'
       when o.fetch_ok then 'COMPLETED' else 'FAILED' end as export_status,
  case when e.archive_id is null then c.updated_at else {NOW} end as updated_at,
  case when e.archive_id is null then c.error_log when not e.valid then 'Parse error: invalid archive location format'
       when o.fetch_ok then null else o.reason end as error_log,
  c.retries
from cur c left join e using (archive_id) left join o using (archive_id)"""
    q["ledger_snapshot"] = q["apply_updates"]
    q["ledger_upsert"] = f"""
select * exclude (late) replace (case when late then 'FAILED' else export_status end as export_status,
                  case when late then {NOW} else updated_at end as updated_at,
                  case when late then 'late' else error_log end as error_log),
  cast(1 as bigint) as rewritten, cast({P.LEDGER_BUCKETS - 1} as bigint) as shared
from (select *, archive_id = max(archive_id) over () as late from ({q["apply_updates"]}))"""
    q["claim_two_runs"] = _with(("c", CLAIMED)) + f"""
select u.archive_id, u.archive_time, u.archive_location, u.raw_eml_size,
  case when claim_seq <= {4 * P.BATCH_SIZE} then 'COMPLETED' else u.export_status end as export_status,
  case when claim_seq <= {4 * P.BATCH_SIZE} then {NOW} else u.updated_at end as updated_at,
  u.error_log, u.retries,
  case when claim_seq <= {4 * P.BATCH_SIZE} then ['A', 'B'][cast((claim_seq - 1) // {P.BATCH_SIZE} % 2 + 1 as int)] end as claimed_by
from cur u left join c using (archive_id)"""
    q["export_two_runs"] = q["export_job"]
    q["file_inventory"] = f"""
with inv as ({INVENTORY})
select path, length, mtime as modificationTime from inv"""
    q["inventory_diff"] = f"""
with inv as ({INVENTORY})
select path, length + case when length % 10 = 2 then 1 else 0 end as length, mtime as modificationTime,
  case length % 10 when 1 then 'gone' when 2 then 'changed' when 3 then 'new' end as change from inv"""
    q["retention_plan"] = f"with inv as ({INVENTORY}), plan as ({PLAN}) select * from plan"
    q["retention_summary"] = f"with inv as ({INVENTORY}), plan as ({PLAN}) {SUMMARY}"
    q["empty_job_dirs"] = f"with inv as ({INVENTORY}), plan as ({PLAN}) {EMPTY_DIRS}"
    q["retention_apply"] = f"""with inv as ({INVENTORY}), plan as ({PLAN})
select path, length, true as deleted, cast(null as varchar) as error from plan"""
    q["retention_job"] = f"""with inv as ({INVENTORY}), plan as ({PLAN}), s as ({SUMMARY}),
e as ({EMPTY_DIRS}) select s.*, (select count(*) from e) as dirs_removed from s"""
    q["total_archive_size"] = f"""with inv as ({INVENTORY})
select job, cast(sum(length) as bigint) as zip_bytes from inv
where lower(regexp_extract(path, '([^/]*)$', 1)) like '%.zip' group by job"""
    q["job_report"] = _with(("inv", INVENTORY), ("a", f"""
select (select count(*) from m) as total,
  (select cast(count_if(export_status = 'COMPLETED') as bigint) from m) as completed,
  (select cast(count_if(export_status = 'FAILED') as bigint) from m) as failed,
  (select cast(coalesce(sum(length), 0) as bigint) from inv where path like '/storage/{P.REPORT_JOB}/%'
     and lower(regexp_extract(path, '([^/]*)$', 1)) like '%.zip') as zip_bytes""")) + f"""
select '{P.REPORT_JOB}' as job, total, completed, failed, total - completed - failed as pending, zip_bytes,
  {format_size_sql('zip_bytes')} as zip_size,
  rtrim('{P.BASE_URL}', '/') || '/{P.REPORT_JOB}' as link, failed > 0 as has_failures
from a"""
    q["audit_log"] = _with(*_pack_ctes(["slot"], False), ("nb0", NUMBERED), ("r", REJECTS), *att[:3],
                           ("v", f"select archive_id from cur where {ELIGIBLE} and {VALID}"), recursive=True) + f"""
select 'errors' as channel, 'parse_failed' as event, archive_id, error_log as detail from r
union all
select 'errors', 'fetch_failed', archive_id, {REASON} from fold
where not fetch_ok and archive_id in (select archive_id from v)
union all
select 'process', 'archived', archive_id, '{P.JOB_ID}/' || printf('emails_%04d.zip', cast(off0 + k as bigint))
from nb0"""
    q["audit_sink"] = q["audit_log"]
    q["stream_manifest"] = q["eligible_records"]
    q["stream_commit"] = q["mark_completed"]
    q["stream_commit_timed"] = q["mark_completed"]
    q["stream_progress"] = f"""select cast(count_if(export_status = 'COMPLETED') as bigint) as completed,
  cast(count_if(export_status = 'FAILED') as bigint) as failed, cast(count(*) as bigint) as total from ({q["mark_completed"]})"""
    q["stream_pack"] = q["pack_next_fit"]
    q["export_stream"] = q["export_job"]
    return q
