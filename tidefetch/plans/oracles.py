"""The registered queries as SQL over the base tables."""

from __future__ import annotations

from tidefetch.plans.queries import (
    GROWING,
    MAX_FILES,
    PARTITIONS,
    POLL_INTERVAL_MS,
    REAPPEARING,
    START_FILE,
    STREAM_STEPS,
)

_NAME = "concat(source, '/', lpad(cast(doc_id as varchar), 12, '0'), '.log')"
_SEP = "concat('|==|', chr(10))"

VIEWS = {
    "idx": f"""
        select {_NAME} as name, lang,
               1704067200000 + (doc_id * 7919 % 997) * 60000 as fetched_ms,
               n_chars as file_size,
               1704067200000 + (doc_id * 7919 % 997) * 60000 - n_chars as modified_ms,
               case when lang <> 'de' then concat('e', cast(doc_id as varchar)) end as etag,
               cast(null as varchar) as request_id
        from documents""",
    "payload": f"""
        select {_NAME} as name, case when lang = 'es' then text else concat(lang, {_SEP}, text) end as body
        from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1)""",
    "split": f"""
        select name, body,
               position({_SEP} in body) as cut
        from payload""",
    "parts": """
        select name,
               case when cut > 0 then substr(body, 1, cut - 1) end as log_metadata,
               case when cut > 0 then substr(body, cut + 5) end as content,
               case when cut = 0 then body end as raw,
               case when cut = 0 then 'Failed to parse: separator not found' end as error
        from split""",
    "records": """
        select i.name, i.lang, i.fetched_ms, i.file_size, i.modified_ms, i.etag, i.request_id,
               p.log_metadata, p.content, p.raw,
               case when p.name is null then concat('File not found: ', i.name) else p.error end as error
        from idx i left join parts p on i.name = p.name""",
    "lines": """
        select i.name, case when p.name is null then concat('File not found: ', i.name) end as error,
               coalesce(len(kept), 0) as records,
               cast(list_sum(list_transform(kept, lambda x: strlen(x))) as bigint) as bytes
        from idx i left join (
          select name, list_filter(string_split(body, chr(10))[2:], lambda x: x <> '') as kept from payload) p
        on i.name = p.name""",
    "spread": f"""
        select name, rn, cast(rn % {PARTITIONS} as integer) as partition_id, rn // {PARTITIONS} as slot
        from (select name, row_number() over (order by fetched_ms, name) - 1 as rn from idx)""",
    "processed": f"""
        select {_NAME} as name from documents where doc_id in (select doc_id from labels)
        union all
        select concat('gone/', cast(page_id as varchar), '.log') as name from pages""",
    "due": "select * from idx where name not in (select name from processed)",
    "listing_old": """
        select event_id as list_pos, concat('u', cast(user_id as varchar), '-', event_type, '.log') as name,
               epoch_us(ts) // 1000 as fetched_ms, cast(floor(value * 100) as bigint) as file_size
        from events where event_type <> 'error'""",
    "listing_fresh": """
        select event_id as list_pos, concat('u', cast(user_id as varchar), '-', event_type, '.log') as name,
               epoch_us(ts) // 1000 + case when value < 20 then -60000 else 0 end as fetched_ms,
               cast(floor(value * 100) as bigint) + 1 as file_size
        from events where event_type <> 'signup'""",
    "downloads": """
        select concat('f', cast(event_id as varchar), '.log') as name, user_id as task_id,
               case when event_type = 'error' then 0 else 1 end as ok,
               cast(floor(value * 100000) as bigint) as bytes, 1 as records,
               cast(floor(value) as bigint) + 1 as ms
        from events""",
    "tasks": """
        select *, case when ms > 0 then records * 1000 // ms else 0 end as records_rate,
               case when ms > 0 then bytes * 1000 // ms else 0 end as bytes_rate
        from (select task_id, cast(sum(ok) as bigint) as files, count(*) filter (where ok = 0) as failed,
                     cast(sum(records) as bigint) as records,
                     cast(sum(case when ok = 1 then bytes else 0 end) as bigint) as bytes,
                     cast(sum(ms) as bigint) as ms
              from downloads group by task_id)""",
    "samples": "select event_id as v, event_id * 500 as ms, event_id * 131072 as bytes from events",
    "json_payload": """
        select concat('j', cast(event_id as varchar), '.json') as name, event_type,
               case event_type
                 when 'error' then concat('error ', props)
                 when 'signup' then concat('{', rest)
                 when 'view' then concat('{"metadata":7,', rest)
                 else concat('{"metadata":"', event_type, '",', rest) end as body
        from (select *, concat('"user":', cast(user_id as varchar), ',"props": ', props, '}') as rest from events)""",
}

_NEEDS = {
    "split": ["payload"],
    "parts": ["split"],
    "records": ["idx", "parts"],
    "lines": ["idx", "payload"],
    "spread": ["idx"],
    "due": ["idx", "processed"],
    "tasks": ["downloads"],
}


def _with(names: list[str], body: str, extra: str = "") -> str:
    """``body`` after the named views and all they are made of."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in ordered)
    return f"with {ctes}{',' + extra if extra else ''}\n{body}"


_INDEX = "name, fetched_ms, file_size, modified_ms, etag, request_id"
_RECORD = """r.name, r.fetched_ms, r.file_size, r.etag, r.log_metadata, md5(r.content) as content_md5,
       cast(strlen(r.content) as bigint) as content_bytes, md5(r.raw) as raw_md5, r.error"""
_DOWNLOAD = _with(["records", "spread"], f"select s.partition_id, {_RECORD} from records r join spread s using (name)")


def _start(condition: str) -> str:
    return _with(["idx"], f"select name, {condition} as skipped from idx")


def _spread(table: str, order_by: str) -> str:
    return f"""select name, cast(rn % {PARTITIONS} as integer) as partition_id, rn // {PARTITIONS} as slot
        from (select name, row_number() over (order by {order_by}) - 1 as rn from {table})"""


def _polled(listed: dict[int, list[str]], max_files: int | None, body: str) -> str:
    """Steps unrolled: ``take_p`` and ``done_p`` for every poll p."""
    extra = ["done_0 as (select name from idx where false)"]
    limit = "" if max_files is None else f"limit {max_files}"
    for number, (poll, langs) in enumerate(listed.items(), 1):
        before = f"done_{number - 1}"
        on_offer = ", ".join(f"'{lang}'" for lang in langs)
        extra += [
            f"list_{poll} as (select * from idx where lang in ({on_offer}))",
            f"""take_{poll} as (select name from list_{poll} where name not in (select name from {before})
                order by fetched_ms, name {limit})""",
            f"""done_{poll} as (
                select name from take_{poll}
                union all
                select name from {before}
                where not exists (select 1 from take_{poll}) or name in (select name from list_{poll}))""",
        ]
    return _with(["idx"], body, ",\n".join(extra))


def _each(listed: dict[int, list[str]], select: str) -> str:
    return "\nunion all\n".join(select.format(p=poll) for poll in listed)


def _rounded(value: str, unit: int) -> str:
    return f"printf('%.2f', floor({value} / {unit}.0 * 100 + 0.5) / 100)"


def _size(value: str) -> str:
    return f"""case when {value} < 1024 then concat(cast({value} as varchar), ' B')
        when {value} < 1048576 then concat({_rounded(value, 1024)}, ' KB')
        when {value} < 1073741824 then concat({_rounded(value, 1048576)}, ' MB')
        else concat({_rounded(value, 1073741824)}, ' GB') end"""


def _rate(value: str) -> str:
    return f"concat({_rounded(value, 1048576)}, ' MB/s')"


def _thousands(value: str) -> str:
    return f"format('{{:,}}', cast({value} as bigint))"


def _duration(value: str) -> str:
    units = [("day", 86400000), ("hour", 3600000), ("minute", 60000), ("second", 1000), ("millisecond", 1)]
    cases = "\n".join(
        f"when {value} % {size} = 0 then concat(cast({value} // {size} as varchar), ' {unit}', "
        f"case when {value} // {size} = 1 then '' else 's' end)"
        for unit, size in units
    )
    return f"case when {value} = 0 then '0 millisecond' {cases} end"


def _summary(column: str) -> str:
    return _with(
        ["tasks"],
        f"""select cast(sum({column}) // count({column}) as bigint) as avg, max({column}) as max,
        min({column}) as min from tasks""",
    )


def _report() -> str:
    shown = {
        "files": (_thousands, lambda v: f"cast({v} as varchar)"),
        "ms": (_duration, _duration),
        "records_rate": (lambda v: f"concat({_thousands(v)}, ' records/sec')",) * 2,
        "bytes_rate": (_rate, _rate),
    }
    labels = {
        "files": "files downloaded",
        "ms": "download duration",
        "records_rate": "records throughput",
        "bytes_rate": "bytes throughput",
    }
    rows = []
    for column, (show_avg, show) in shown.items():
        rows.append(f"select 'avg {labels[column]}' as metric, {show_avg(f'avg_{column}')} as value from wide")
        rows += [
            f"select '{kind} {labels[column]}' as metric, {show(f'{kind}_{column}')} as value from wide"
            for kind in ("max", "min")
        ]
    rows.append(f"select 'total bytes downloaded' as metric, {_size('total')} as value from wide")
    figures = ", ".join(
        f"cast(sum({c}) // count({c}) as bigint) as avg_{c}, max({c}) as max_{c}, min({c}) as min_{c}" for c in shown
    )
    wide = f"wide as (select {figures}, cast(sum(bytes) as bigint) as total from tasks)"
    return _with(["tasks"], "\nunion all\n".join(rows), wide)


def _fields() -> str:
    rows = [
        ("logMetadata", "string", True, "log_metadata"),
        ("logContent", "binary", True, "content"),
        ("rawFileBinary", "binary", True, "raw"),
        ("downloadTimestamp", "timestamp", False, "*"),
        ("error", "string", True, "error"),
        ("sourceFile.name", "string", False, "name"),
        ("sourceFile.fetchedAt", "timestamp", False, "fetched_ms"),
        ("sourceFile.fileSize", "bigint", True, "file_size"),
        ("sourceFile.lastModified", "timestamp", True, "modified_ms"),
        ("sourceFile.etag", "string", True, "etag"),
        ("sourceFile.requestId", "string", True, "request_id"),
    ]
    return "\nunion all\n".join(
        f"select '{field}' as field, '{kind}' as type, {str(nullable).lower()} as nullable, "
        f"count({column}) as filled from records"
        for field, kind, nullable, column in rows
    )


ORACLES: dict[str, str] = {
    "batch_read": _with(
        ["records", "spread"], f"select s.partition_id, s.slot, {_RECORD} from records r join spread s using (name)"
    ),
    "list_index": _with(["idx"], f"select {_INDEX} from idx"),
    "download_rows": _DOWNLOAD,
    "download_prefetch": _DOWNLOAD,
    "download_failures": _with(
        ["payload", "spread"],
        """select name, partition_id, concat('File not found: ', name) as error, cast(0 as bigint) as bytes
        from spread where name not in (select name from payload)""",
    ),
    "download_join": _with(
        ["idx", "payload"],
        """select i.name, cast(strlen(p.body) as bigint) as bytes, md5(p.body) as md5,
        case when p.name is null then concat('File not found: ', i.name) end as error
        from idx i left join payload p on i.name = p.name""",
    ),
    "batch_remote": _with(
        ["records", "spread"], f"select s.partition_id, s.slot, {_RECORD} from records r join spread s using (name)"
    ),
    "format_read": _with(["records"], f"select {_RECORD} from records r"),
    "task_figures_empty": _with(
        ["lines", "spread"],
        """select s.partition_id, count(*) filter (where l.error is null) as files,
               count(*) filter (where l.error is not null) as failed,
               cast(sum(l.records + case when l.error is null then 0 else 1 end) as bigint) as records,
               cast(sum(coalesce(l.bytes, 0)) as bigint) as bytes
        from lines l join spread s using (name) group by s.partition_id""",
    ),
    "download_lines": _with(
        ["lines"], "select name, error, records, bytes from lines where records > 0 or error is not null"
    ),
    "schema_fixed": _with(["records"], _fields()),
    "no_broadcast_join": _with(
        ["records"], "select name, lang, cast(strlen(content) as bigint) as content_bytes from records"
    ),
    "project_partial": _with(
        ["records"],
        """select name, file_size, cast(null as varchar) as owner, cast(null as varchar) as colour, error
        from records""",
    ),
    "source_struct": _with(["idx"], f"select {_INDEX} from idx"),
    "ts_millis": "select event_id, epoch_us(ts) // 1000 * 1000 as us from events",
    "split_separator": _with(
        ["parts"], "select name, log_metadata, md5(content) as content_md5, md5(raw) as raw_md5, error from parts"
    ),
    "split_json": _with(
        ["json_payload"],
        """select name,
        case when event_type in ('click', 'purchase') then json_extract_string(body, '$.metadata') end as log_metadata,
        case when event_type <> 'error' then cast(json_merge_patch(body, '{"metadata":null}') as varchar) end as content,
        case when event_type = 'error' then body end as raw,
        case when event_type = 'error' then 'Failed to parse JSON: malformed document' end as error
        from json_payload""",
    ),
    "dead_letters": _with(["records"], "select name, error from records where error is not null"),
    "order_fetched": _with(["idx"], "select name, row_number() over (order by fetched_ms, name) - 1 as rn from idx"),
    "order_custom": _with(["idx"], "select name, row_number() over (order by name desc) - 1 as rn from idx"),
    "round_robin_fetched": _with(["spread"], "select name, partition_id, slot from spread"),
    "round_robin_name": _with(["idx"], _spread("idx", "name")),
    "round_robin_scaled": "with o as (select concat(o_orderpriority, '/', cast(o_orderkey as varchar)) as name,"
    f" o_orderdate from orders) {_spread('o', 'o_orderdate, name')}",
    "round_robin_placed": _with(["spread"], "select name, partition_id from spread"),
    "partition_sizes": _with(
        ["spread"], "select partition_id, count(*) as files from spread group by partition_id"
    ),
    "unprocessed": _with(["due"], f"select {_INDEX} from due"),
    "still_listed": _with(["idx", "processed"], "select name from idx where name in (select name from processed)"),
    "start_earliest": _start("false"),
    "start_latest": _start("true"),
    "start_file": _start(f"name < '{START_FILE.removeprefix('file:')}'"),
    "rate_limited": _with(["due"], f"select {_INDEX} from due order by fetched_ms, name limit {MAX_FILES}"),
    "next_position": _with(
        ["due"],
        f"""(select name from due order by fetched_ms, name limit {MAX_FILES})
        union select name from processed where name in (select name from idx)""",
    ),
    "next_position_snapshot": _with(
        ["due"], f"(select name from due order by name limit {MAX_FILES}) union select name from processed"
    ),
    "files_between": _with(["due"], "select name from due"),
    "positions_equal": _with(
        ["idx", "processed"],
        """select 'split' as pair, true as equal
        union all
        select 'processed' as pair,
               not exists (select name from idx except select name from processed)
               and not exists (select name from processed except select name from idx) as equal""",
    ),
    "merge_listings": _with(
        ["listing_old", "listing_fresh"],
        """select list_pos, name, fetched_ms, file_size from (
          select *, row_number() over (partition by name order by fetched_ms, src, list_pos) as k from (
            select *, 0 as src from listing_old where name in (select name from listing_fresh)
            union all
            select *, 1 as src from listing_fresh))
        where k = 1""",
    ),
    "available_now_plan": _with(
        ["due"],
        f"select name, rn, rn // {MAX_FILES} as step from"
        " (select name, row_number() over (order by name) - 1 as rn from due)",
    ),
    "plan_steps": _polled(
        GROWING,
        MAX_FILES,
        _each(GROWING, "select {p} as poll, name, name in (select name from take_{p}) as taken from done_{p}"),
    ),
    "reappearing_file": _polled(REAPPEARING, None, _each(REAPPEARING, "select {p} as poll, name from take_{p}")),
    "poll_counts": _polled(
        GROWING,
        MAX_FILES,
        _each(
            GROWING,
            "select {p} as poll, (select count(*) from list_{p}) as discovered,"
            " (select count(*) from done_{p}) as consumed",
        ),
    ),
    "poll_throttle": f"""
        with recursive polls as (select distinct user_id as source, epoch_us(ts) // 1000 as poll_ms from events),
        next_poll as (
          select source, poll_ms, min(poll_ms) over (
            partition by source order by poll_ms
            range between {POLL_INTERVAL_MS} following and unbounded following) as next_ms
          from polls),
        kept as (
          select source, min(poll_ms) as poll_ms from polls group by source
          union all
          select k.source, n.next_ms from kept k join next_poll n on k.source = n.source and k.poll_ms = n.poll_ms
          where n.next_ms is not null)
        select source, poll_ms from kept""",
    "task_metrics": _with(["tasks"], "select * from tasks"),
    "failed_files": _with(["downloads"], "select task_id, name from downloads where ok = 0"),
    "metrics_files": _summary("files"),
    "metrics_bytes_total": _with(["tasks"], "select cast(sum(bytes) as bigint) as total from tasks"),
    "metrics_duration": _summary("ms"),
    "metrics_records_rate": _summary("records_rate"),
    "metrics_bytes_rate": _summary("bytes_rate"),
    "metrics_report": _report(),
    "fmt_duration": _with(["samples"], f"select ms, {_duration('ms')} as text from samples"),
    "fmt_records_rate": _with(["samples"], f"select v, concat({_thousands('v')}, ' records/sec') as text from samples"),
    "fmt_bytes_rate": _with(["samples"], f"select bytes, {_rate('bytes')} as text from samples"),
    "fmt_bytes": _with(["samples"], f"select bytes, {_size('bytes')} as text from samples"),
    "parse_duration": """
        select event_id,
        case event_type
          when 'view' then cast(trunc(round(value * 1000000000) / 1000000) as bigint)
          when 'click' then cast(trunc(round(value * 60000000000) / 1000000) as bigint)
          when 'signup' then cast(trunc(round(value * 1000000) / 1000000) as bigint)
          when 'purchase' then cast(trunc(round(value * 1000) / 1000000) as bigint) end as ms
        from events""",
    "stream_read": _with(
        ["records", "due"],
        f"select s.step, {_RECORD} from records r join steps s using (name)",
        f"""steps as (
          select name, rn // greatest(1, (total + {STREAM_STEPS - 1}) // {STREAM_STEPS}) as step
          from (select name, row_number() over (order by name) - 1 as rn, count(*) over () as total from due))""",
    ),
}
