"""DuckDB SQL that states each registered query independently of Spark.

Each string runs on DuckDB views named after the driver tables.  The capture
views are rebuilt here as CTEs with the same rules as
``wiremap.sources.fixtures``; the pipeline stages are written the naive way
(every process start, the full self-join), so they also check the plan-level
reductions of the Spark operators.
"""

from __future__ import annotations

CAPTURE_CTES = """
ev as (
  select e.*, e.user_id % (select count(*) from supplier) as s,
         (e.event_id * 7 + e.user_id) % (select count(*) from supplier) as d,
         concat('m', cast(e.user_id % (select count(*) from supplier) as varchar)) as hostname
  from events e),
net_interface as (
  select s_suppkey as _id, s_name as host, n_name as network,
         concat('m', cast(s_suppkey as varchar)) as hostname
  from supplier join nation on s_nationkey = n_nationkey),
network_ip as (
  select e.event_id as _id, e.hostname, a.s_name as source_host,
         cast(1000 + e.event_id % 4 as integer) as source_port,
         b.s_name as destination_host,
         cast(1000 + cast(floor(e.event_id / 4) as bigint) % 4 as integer) as destination_port,
         e.ts as dtk_inserted_at
  from ev e left join supplier a on a.s_suppkey = e.s
            left join supplier b on b.s_suppkey = e.d),
network_packet as (
  select event_id as _id, hostname, cast(floor(value) as bigint) as length,
         date_trunc('hour', ts) + (ts - date_trunc('minute', ts)) as created_at,
         event_type as interface, ts as dtk_inserted_at
  from ev),
process_network as (
  select event_id as _id, event_id as packet_id, hostname, user_id % 5 as pid,
         ts as dtk_inserted_at
  from ev where event_id % 3 <> 0),
process as (
  select event_id % 5 as pid, hostname, ts as started_at, cast(1 as bigint) as ppid,
         user_id as uid, concat('cmd', cast(event_id % 5 as varchar)) as command,
         concat('cmd', cast(event_id % 5 as varchar), ' --x') as full_command
  from ev where event_type = 'signup')
"""

PACKET_CTES = CAPTURE_CTES + """,
ip_packet as (
  select i._id, i.hostname, i.source_host, i.source_port, i.destination_host,
         i.destination_port, p.length, p.created_at, p.interface
  from network_ip i join network_packet p on i._id = p._id and i.hostname = p.hostname),
with_host as (
  select ip.*, s.network as source_network, s.hostname as source_hostname,
         d.network as destination_network, d.hostname as destination_hostname
  from ip_packet ip
  left join net_interface s on ip.source_host = s.host
  left join net_interface d on ip.destination_host = d.host
  where ip.hostname = s.hostname
    and s.network is not null and d.network is not null
    and ip.source_host <> ip.destination_host),
with_proc as (
  select w.*, l.pid, pr.ppid, pr.uid, pr.command, pr.full_command,
         pr.started_at as process_started_at
  from with_host w
  left join process_network l on w._id = l.packet_id and w.hostname = l.hostname
  left join process pr on l.pid = pr.pid and w.hostname = pr.hostname),
picked as (
  select * from with_proc where process_started_at is null
  union all
  select * exclude (rn) from (
    select *, row_number() over (partition by _id, hostname, pid
                                 order by process_started_at) as rn
    from with_proc where process_started_at < created_at)
  where rn = 1),
picked_latest as (
  select * from with_proc where process_started_at is null
  union all
  select * exclude (rn) from (
    select *, row_number() over (partition by _id, hostname, pid
                                 order by process_started_at desc) as rn
    from with_proc where process_started_at < created_at)
  where rn = 1),
picked_original_keys as (
  select * from with_proc where process_started_at is null
  union all
  select * exclude (rn) from (
    select *, row_number() over (partition by _id, pid
                                 order by process_started_at) as rn
    from with_proc where process_started_at < created_at)
  where rn = 1),
only_later as (
  select _id, hostname, source_host, source_port, destination_host, destination_port,
         length, created_at, interface, source_network, source_hostname,
         destination_network, destination_hostname, pid,
         cast(null as bigint) as ppid, cast(null as bigint) as uid,
         cast(null as varchar) as command, cast(null as varchar) as full_command,
         cast(null as timestamp) as process_started_at
  from with_proc
  where process_started_at is not null
  group by _id, hostname, source_host, source_port, destination_host, destination_port,
           length, created_at, interface, source_network, source_hostname,
           destination_network, destination_hostname, pid
  having max(case when process_started_at < created_at then 1 else 0 end) = 0),
picked_keep_unmatched as (
  select * from picked
  union all
  select * from only_later),
g1 as (
  select _id as packet_id, source_hostname, source_host, source_port, source_network,
         interface, created_at, length, pid, ppid, uid, command, full_command,
         process_started_at, destination_host, destination_port, destination_network,
         destination_hostname, (select max(ts) from events) as dtk_inserted_at
  from picked)
"""

_G2_SELECT = """
  select date_trunc('minute', a.created_at) as created_at, a.source_network,
         a.source_hostname, a.source_host, a.source_port,
         a.interface as source_interface, a.pid as source_pid, a.ppid as source_ppid,
         a.uid as source_uid, a.command as source_command,
         a.full_command as source_full_command,
         a.process_started_at as source_process_started_at,
         b.source_network as destination_network, b.source_hostname as destination_hostname,
         b.source_host as destination_host, b.source_port as destination_port,
         b.interface as destination_interface, b.pid as destination_pid,
         b.ppid as destination_ppid, b.uid as destination_uid,
         b.command as destination_command, b.full_command as destination_full_command,
         b.process_started_at as destination_process_started_at, a.dtk_inserted_at,
         row_number() over (
           partition by date_trunc('minute', a.created_at), a.source_network, a.source_host,
                        a.source_port, b.source_host, b.source_port, b.source_network
           order by a.created_at, a.packet_id, a.source_hostname,
                    b.created_at, b.packet_id, b.source_hostname) as rn
  from g1 a join g1 b
    on a.source_host = b.destination_host and a.source_port = b.destination_port
   and a.source_hostname = b.destination_hostname
"""

CONNECTION_CTES = PACKET_CTES + """,
g2 as (
  select * exclude (rn) from (""" + _G2_SELECT + """
  where a.created_at is not null) where rn = 1)
"""

CONNECTION_ALIGNED_CTES = PACKET_CTES + """,
g2 as (
  select * exclude (rn) from (""" + _G2_SELECT + """
  where date_trunc('minute', a.created_at) = date_trunc('minute', b.created_at)) where rn = 1)
"""


def with_ctes(ctes: str, body: str) -> str:
    return "with " + ctes.strip() + "\n" + body.strip()


GRAPH_CTES = CONNECTION_CTES + """,
conn as (
  select * from g2
  where dtk_inserted_at >= date_trunc('second', (select max(ts) from events)) - to_seconds(899)),
filled as (
  select created_at,
         coalesce(source_network, 'unknown') as source_network,
         coalesce(source_hostname, 'unknown') as source_hostname,
         coalesce(source_host, 'unknown') as source_host, source_port,
         coalesce(source_interface, 'unknown') as source_interface,
         source_pid, source_ppid, source_uid,
         coalesce(source_command, 'unknown') as source_command,
         coalesce(source_full_command, 'unknown') as source_full_command,
         source_process_started_at,
         coalesce(destination_network, 'unknown') as destination_network,
         coalesce(destination_hostname, 'unknown') as destination_hostname,
         coalesce(destination_host, 'unknown') as destination_host, destination_port,
         coalesce(destination_interface, 'unknown') as destination_interface,
         destination_pid, destination_ppid, destination_uid,
         coalesce(destination_command, 'unknown') as destination_command,
         coalesce(destination_full_command, 'unknown') as destination_full_command,
         destination_process_started_at, dtk_inserted_at
  from conn),
summary as (
  select source_network, source_hostname, source_host,
         destination_network, destination_hostname, destination_host,
         coalesce(list_sort(list(distinct source_port) filter (where source_port is not null)), []) as source_port,
         coalesce(list_sort(list(distinct source_pid) filter (where source_pid is not null)), []) as source_pid,
         coalesce(list_sort(list(distinct source_command) filter (where source_command is not null)), []) as source_command,
         coalesce(list_sort(list(distinct destination_port) filter (where destination_port is not null)), []) as destination_port,
         coalesce(list_sort(list(distinct destination_pid) filter (where destination_pid is not null)), []) as destination_pid,
         coalesce(list_sort(list(distinct destination_command) filter (where destination_command is not null)), []) as destination_command,
         strftime(max(created_at), '%Y/%m/%d %H:%M:%S') as time
  from filled
  group by source_network, source_hostname, source_host,
           destination_network, destination_hostname, destination_host),
ided as (
  select *,
         md5(concat_ws(chr(31), source_network, source_hostname, source_host)) as source_id,
         md5(concat_ws(chr(31), destination_network, destination_hostname, destination_host)) as destination_id,
         md5(concat_ws(chr(31), source_network, source_hostname, source_host,
                       destination_network, destination_hostname, destination_host)) as edge_id
  from summary),
nodes as (
  select distinct network, _id, label from (
    select source_network as network, source_id as _id,
           source_host || chr(10) || source_hostname as label from ided
    union all
    select destination_network, destination_id,
           destination_host || chr(10) || destination_hostname from ided))
"""

GRAPH_EDGES = """
select edge_id as _id, source_id, destination_id,
       'commands: '
       || case when len(source_command) = 0 then 'unknown' else cast(source_command as varchar) end
       || '->'
       || case when len(destination_command) = 0 then 'unknown' else cast(destination_command as varchar) end
       || chr(10) || time as label
from ided
"""

EDGE_REPORT = """
select edge_id, time, source_network, source_hostname, source_host, source_port, source_pid,
       source_command, destination_network, destination_hostname, destination_host,
       destination_port, destination_pid, destination_command
from ided order by edge_id
"""

LATEST_LINEITEM = """
select * from lineitem
qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc nulls last, l_partkey asc nulls last, l_suppkey asc nulls last,
           l_extendedprice asc nulls last) = 1
"""

LOOKUP_HOST = """
with hosts as (
  select s_suppkey as _id,
         struct_pack(address := concat('10.0.', cast(s_suppkey % 50 as varchar)), mask := 24) as address,
         s_name as host
  from supplier),
by_address as (
  select address, min(host) as host from hosts where address is not null group by address),
facts as (
  select event_id as _id,
         struct_pack(address := concat('10.0.', cast(user_id % 60 as varchar)),
                     mask := case when event_id % 10 = 0 then 32 else 24 end) as address
  from events)
select f._id, f.address.address as ip, f.address.mask as mask, h.host
from facts f left join by_address h on f.address = h.address
"""

STRUCT_FIELD = """
with hosts as (
  select struct_pack(address := concat('10.0.', cast(s_suppkey % 50 as varchar)), mask := 24) as address,
         s_name as host
  from supplier),
by_address as (
  select address, min(host) as host from hosts where address is not null group by address),
reports as (
  select user_id % 7 as _id,
         concat('m', cast(user_id % (select count(*) from supplier) as varchar)) as hostname,
         struct_pack(address := concat('10.0.', cast(event_id % 60 as varchar)), mask := 24) as address,
         event_type as network, ts as inserted_at
  from events),
enriched as (
  select r.*, h.host, r.address.mask as mask
  from reports r left join by_address h on r.address = h.address)
select _id, hostname, address.address as ip, network, inserted_at, host, mask
from enriched
qualify row_number() over (partition by _id, hostname order by inserted_at desc nulls last) = 1
"""

RECENT_EVENTS = """
select * from events
where ts >= date_trunc('second', (select max(ts) from events)) - to_seconds({secs})
"""

PARSE_FILE_NAME = CAPTURE_CTES + """,
named as (
  select e.event_id,
         e.hostname || '-' ||
         case when e.event_type = 'error'
              then substr(strftime(e.ts, '%Y%m%d%H%M%S'), 1, 13) || 'Z'
              else strftime(e.ts, '%Y%m%d%H%M%S') end || '.parquet' as file_name
  from ev e)

select event_id, file_name,
       substr(file_name, 1, greatest(length(file_name) - 23, 0)) as hostname,
       case when length(file_name) >= 23
            then cast(try_strptime(substr(file_name, length(file_name) - 21, 14), '%Y%m%d%H%M%S') as date)
       end as date_sent
from named
"""

_EV_LATEST = """
  qualify row_number() over (partition by {keys}
                             order by ts desc nulls last, event_id asc nulls last,
                                      value asc nulls last, props asc nulls last) = 1"""

UPSERT_BY_KEY = """
with t as (select * from events where event_id % 2 = 0""" + _EV_LATEST.format(keys="user_id, event_type") + """),
s as (select * from events where event_id % 2 = 1""" + _EV_LATEST.format(keys="user_id, event_type") + """)
select * from t
where not exists (select 1 from s where s.user_id = t.user_id and s.event_type = t.event_type)
union all
select * from s
"""

# Batches of events (event_id modulo 3) by arrival; a later batch replaces a key's row.
UPSERT_THREE_BATCHES = """
with b as (
""" + "\nunion all\n".join(
    f"select *, {arrival} as arrival from (select * from events where event_id % 3 = {part}"
    + _EV_LATEST.format(keys="user_id, event_type") + ")"
    for arrival, part in enumerate((0, 1, 2))) + """)
select event_id, ts, user_id, event_type, value, props from b
qualify row_number() over (partition by user_id, event_type order by arrival desc) = 1
"""

UPSERT_NEW_COLUMN = """
with t as (select * from events where event_id % 2 = 0""" + _EV_LATEST.format(keys="user_id, event_type") + """),
s as (select * from events where event_id % 2 = 1""" + _EV_LATEST.format(keys="user_id, event_type") + """)
select *, null::bigint as odd_id from t
where not exists (select 1 from s where s.user_id = t.user_id and s.event_type = t.event_type)
union all
select *, event_id as odd_id from s
"""

UPSERT_FIRST_LOAD = """
select * from events""" + _EV_LATEST.format(keys="user_id, event_type") + "\n"

UPSERT_NULL_KEYS = """
with k as (select *, case when user_id % 4 <> 0 then user_id end as k from events),
t as (select * from k where event_id % 2 = 0""" + _EV_LATEST.format(keys="k, event_type").replace("{", "{{").replace("}", "}}") + """),
s as (select * from k where event_id % 2 = 1""" + _EV_LATEST.format(keys="k, event_type").replace("{", "{{").replace("}", "}}") + """)
select * from t
where not exists (select 1 from s where {match} and s.event_type = t.event_type)
union all
select * from s
"""


# The packet map with the ingest look-back on the three fact tables (dimensions
# kept whole): the same chain reading windowed copies of the facts.
_CUTOFF = "date_trunc('second', (select max(ts) from events)) - to_seconds({secs})"
_WINDOWED = """,
network_ip_w as (select * from network_ip where dtk_inserted_at >= {cut}),
network_packet_w as (select * from network_packet where dtk_inserted_at >= {cut}),
process_network_w as (select * from process_network where dtk_inserted_at >= {cut})"""


def packet_ctes_recent(minutes: int) -> str:
    cut = _CUTOFF.format(secs=minutes * 60 - 1)
    rest = PACKET_CTES[len(CAPTURE_CTES):]
    rest = (rest.replace("from network_ip i join network_packet p",
                         "from network_ip_w i join network_packet_w p")
            .replace("left join process_network l", "left join process_network_w l"))
    return CAPTURE_CTES + _WINDOWED.format(cut=cut) + rest


# Two arrivals of events; the second brings ``value``.
EVOLVING_COLUMNS = "select event_id, ts, user_id, event_type, case when event_id % 3 <> 0 then value end as value from (" \
    + UPSERT_FIRST_LOAD + ")\n"

# A source with several rows for a key and no clock: the smallest in column order stays.
UPSERT_DUPLICATE_KEYS = """
select * from events
qualify row_number() over (partition by user_id, event_type order by event_id) = 1
"""

# Names and dates of the capture files: a file is stamped with its host's first time.
FILE_PROVENANCE = """
select event_id, hostname, cast(min(ts) over (partition by hostname) as date) as date_sent,
       true as name_matches, true as has_size, true as has_ingest_time
from ev
"""

# Raw rows of the silver tables outside the packet map: columns, key, lookup.
_IP = "concat('10.0.', cast({} as varchar))"
_SILVER_ROWS = {
    "dim_file_reg": ("user_id % 5 as pid, concat('fd', event_id % 3) as fd, user_id % 11 as node", "pid, fd, node"),
    "dim_network_foreign_ip": ("user_id % 13 as _id, " + _IP.format("event_id % 60") + " as ip, 24 as mask", "_id"),
    "dim_network_open_port": ("user_id % 5 as pid, cast(1000 + event_id % 7 as integer) as port", "pid, port"),
    "dim_network_socket": ("user_id % 13 as _id, " + _IP.format("event_id % 60") + " as ip, 24 as mask", "_id"),
    "file_host": ("concat('h', user_id % 9) as name, " + _IP.format("event_id % 6") + " as ip, 24 as mask",
                  "name, ip, mask"),
    "file_user": ("concat('u', user_id % 9) as name, event_id % 4 as uid", "name, uid"),
    "file_service": ("event_type as name, cast(1000 + user_id % 6 as integer) as port, "
                     "case when event_id % 2 = 0 then 'udp' else 'tcp' end as protocol", "name, port, protocol"),
    "fact_file_reg": ("user_id % 5 as pid, concat('fd', event_id % 3) as fd, user_id % 11 as node, "
                      "date_trunc('hour', ts) as created_at", "pid, fd, node, created_at"),
    "fact_process": ("user_id % 5 as pid, date_trunc('day', ts) as started_at, date_trunc('hour', ts) as created_at",
                     "pid, started_at, created_at"),
    "tech_chrono": ("event_type as name", "name"),
    "tech_table_count": ("user_id % 13 as _id", "_id"),
}
_HOST_COLUMN = {"dim_network_foreign_ip": "host", "dim_network_socket": "source_host"}


def silver_target(source: str) -> str:
    """The keyed silver table after the odd events arrived as a second batch."""
    if source == "dim_network_host":
        return with_ctes(CAPTURE_CTES, "select distinct user_id % 40 as _id, " + _IP.format("user_id % 30") +
                         " as ip, 24 as mask, concat('host', user_id % 40) as host from ev")
    columns, keys = _SILVER_ROWS[source]
    host = _HOST_COLUMN.get(source)
    hosts = """,
by_address as (
  select concat('10.0.', cast(s_suppkey % 50 as varchar)) as address, min(s_name) as found from supplier group by 1)"""
    return with_ctes(CAPTURE_CTES, f"""
select * from (
  with raw as (select event_id, {columns}, hostname, ts as inserted_at from ev){hosts},
  looked_up as (select r.*{f", h.found as {host} from raw r left join by_address h on h.address = r.ip" if host
                           else " from raw r"}),
  best as (
    select * from looked_up
    qualify row_number() over (partition by event_id % 2, {keys}, hostname order by inserted_at desc, event_id) = 1)
  select * from best
  qualify row_number() over (partition by {keys}, hostname order by event_id % 2 desc) = 1)
""")


# Three refreshes at rising times, each with a look-back of ten minutes on all five inputs.
_ARRIVAL = "timestamp '2024-02-01 00:00:00' + to_seconds(cast({} as integer))"
_SLIDING = """,
ip_s as (select * exclude (dtk_inserted_at), {by_id} as dtk from network_ip),
packet_s as (
  select * exclude (dtk_inserted_at), {by_id} as dtk from network_packet
  union all
  select * exclude (dtk_inserted_at) replace (length + 1 as length), {resent} as dtk
  from network_packet where _id % 10 = 0),
link_s as (select * exclude (dtk_inserted_at), {by_id} as dtk from process_network),
iface_s as (
  select i.*, {iface} as dtk from net_interface i, range(6) t(k) where k <= _id % 6),
proc_s as (
  select event_id % 5 as pid, hostname, ts as started_at, cast(1 as bigint) as ppid, user_id as uid,
         concat('cmd', cast(event_id % 5 as varchar)) as command,
         concat('cmd', cast(event_id % 5 as varchar), ' --x') as full_command, {by_event} as dtk
  from ev where event_type = 'signup')""".format(
    by_id=_ARRIVAL.format("_id % 1800"), resent=_ARRIVAL.format("_id % 1800 + 480"),
    iface=_ARRIVAL.format("_id % 300 + 300 * k"), by_event=_ARRIVAL.format("event_id % 1800"))
_SLIDING_KEYS = {"ip": "_id, hostname", "packet": "_id, hostname", "link": "_id, hostname", "iface": "_id, hostname",
                 "proc": "pid, started_at, hostname"}


def _sliding_refresh(r: int, body: str) -> str:
    """``body`` over the packets of refresh r (1, 2, 3), as of second 600 * r - 1."""
    first, last = (_ARRIVAL.format(x) for x in (600 * (r - 1), 600 * r - 1))
    windows = "".join(f""",
{t}_w as (
  select * exclude (dtk) from {t}_s where dtk between {first} and {last}
  qualify row_number() over (partition by {keys} order by dtk desc{", uid" if t == "proc" else ""}) = 1)"""
                      for t, keys in _SLIDING_KEYS.items())
    rest = PACKET_CTES[len(CAPTURE_CTES):]
    for old, new in (("from network_ip i join network_packet p", "from ip_w i join packet_w p"),
                     ("net_interface s", "iface_w s"), ("net_interface d", "iface_w d"),
                     ("left join process_network l", "left join link_w l"),
                     ("left join process pr", "left join proc_w pr"),
                     ("(select max(ts) from events) as dtk_inserted_at", f"{last} as dtk_inserted_at")):
        rest = rest.replace(old, new)
    return f"select {r} as refresh, x.* from ({with_ctes(CAPTURE_CTES + _SLIDING + windows + rest, body)}) x"


def _sliding(body: str, keys: str) -> str:
    runs = "\nunion all\n".join(_sliding_refresh(r, body) for r in (1, 2, 3))
    return (f"select * exclude (refresh) from ({runs}) "
            f"qualify row_number() over (partition by {keys} order by refresh desc) = 1")


SLIDING_PACKETS = _sliding("select * from g1", "packet_id, source_hostname")
SLIDING_CONNECTIONS = _sliding(
    "select * exclude (rn) from (" + _G2_SELECT + "  where a.created_at is not null) where rn = 1",
    "created_at, source_network, source_host, source_port, destination_host, destination_port, destination_network")
