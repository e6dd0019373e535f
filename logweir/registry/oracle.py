"""The same answers as plain SQL over the given tables, for an independent engine."""

# Message text per event, as in the fixtures module.
LINES = """lines as (
 select event_id * 4 + r as seq, event_id, concat_ws('|',
   case when event_id % 1009 = 5 then 'bad-ip' else '10.' || (user_id % 8) || '.' || (event_id % 4 * 4) || '.' || (1 + user_id % 5 * 50) end,
   case when r = 3 then upper(event_type || '.example.com') when event_id % 3 = 0 then event_type || '.example.org'
     when event_id % 3 = 1 then upper(event_type) || '.Example.com' else event_type || '.example.com' end,
   case when event_id % 83 = 0 then '2024' else strftime(timestamp '2024-01-31 12:00:00' + to_seconds(event_id * 5), '%Y%m%d%H%M%S') end,
   case when event_id % 20 = 19 then '203.0.113.9' when event_id % 10 < 7 then '106.38.176.185' when event_id % 10 = 7 then '106.38.176.117'
     when event_id % 10 = 8 then '106.38.176.118' else '106.38.176.116' end,
   case when r = 2 then '3' when event_id % 103 = 0 then 'NA' when event_id % 11 = 0 then '2' else '0' end,
   '1',
   case when event_id % 5 = 0 then '' when event_id % 5 = 1 then 'Other.NET' else event_type || '.example.com' end,
   case when event_id % 97 = 0 then null else '' end,
   case when event_id % 89 = 0 then '' else '8.8.' || (user_id % 4) || '.8' end,
   case when event_id % 101 = 7 then 'x' end) as value
 from (select event_id, user_id, event_type, unnest([0, 1, 2, 3]) r from events)
 where r = 0 or (r = 1 and event_id % 50 = 0) or (r = 2 and event_id % 60 = 0) or (r = 3 and event_id % 70 = 2))"""

SPLIT = """split as (select seq, event_id, value, string_split(regexp_replace(value, '[|]+$', ''), '|') a from lines)"""
FIELDS = """a[1] client_ip, a[2] domain, a[3] as "time", a[4] target_ip, a[5] rcode, a[6] query_type,
 a[7] authority_record, a[8] add_msg, a[9] dns_ip"""
DNS = f"{LINES}, {SPLIT}, dns as (select seq, event_id, {FIELDS} from split where len(a) = 9)"
# Messages of the JSON form: every 107th is not JSON.
JSON_DNS = f"{DNS}, jdns as (select * from dns where seq % 107 <> 3)"
RECORD = 'client_ip, domain, "time", target_ip, rcode, query_type, authority_record, add_msg, dns_ip'
PARTS = 'substr("time", 1, 4) as "year", substr("time", 5, 2) as "month", substr("time", 7, 2) as "day"'
T = """try_strptime("time", '%Y%m%d%H%M%S')"""
ID = 'client_ip || domain || "time"'


def number(ip):
    return " + ".join(
        f"try_cast(split_part({ip}, '.', {i}) as bigint) * {256 ** (4 - i)}" for i in (1, 2, 3, 4)
    )


GEO = f"""raw as (
 select case when k % 211 = 0 then 'unknown' else '10.' || (k % 9) || '.' || (o // 256) || '.' || (o % 256) end ip_start,
  '10.' || (k % 9) || '.' || (t // 256) || '.' || (t % 256) ip_end, r_name country, n_name province,
  'city_' || (k % 1000) city, 'op_' || (k % 3) "operator"
 from (select c_custkey k, c_nationkey, c_custkey * 97 % 4096 o, c_custkey * 97 % 4096 + c_custkey * 31 % 300 t from customer)
 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
numbered as (select *, {number('ip_start')} lo, {number('ip_end')} hi,
  concat_ws('-', ip_start, ip_end, country, province, city, "operator") member from raw),
geo as (select * from numbered where lo is not null
  qualify row_number() over (partition by hi order by member) = 1)"""
WIDE_GEO = GEO.replace("from raw)", """from (from raw union all
 select '0.0.0.0', '255.255.255.255', 'ALL', 'all', 'everywhere', 'op_all'))""")
LABELS = 'country, province, city, "operator"'
LOCATED = f"""asked as (select *, {number('client_ip')} ip from dns),
located as (select a.*, {', '.join(f'case when g.lo <= a.ip then g.{c} end {c}' for c in ('country', 'province', 'city', '"operator"'))}
 from asked a asof left join geo g on a.ip <= g.hi)"""

BLOCKS = f"""blocks4 as (select cidr, net, cidr || '-' || net member, {number("split_part(cidr, '/', 1)")} ip, cast(split_part(cidr, '/', 2) as int) m
 from (select case when c_custkey % 223 = 0 then 'x/33' when c_custkey % 199 = 0 then '0.0.0.0/0'
  else '10.' || (c_custkey % 9) || '.' || (c_custkey * 5 % 16) || '.' || (c_custkey * 97 % 256) || '/' || (10 + c_custkey % 23) end cidr,
  'net_' || (c_custkey % 1000) net from customer)),
bounds4 as (select *, ip - ip % (1::bigint << (32 - m)) lo, ip - ip % (1::bigint << (32 - m)) + (1::bigint << (32 - m)) - 1 hi
 from (select * from blocks4 where m <= 32))"""


def ipv6_groups(g2, g5, g7):
    """The eight groups of a fixture address, as a list of numbers."""
    return f"[8193, 3512, {g2}, 0, 0, {g5}, 0, {g7}]"


EVENT6 = ipv6_groups("user_id % 65536", "event_id % 16", "event_id % 65536")
BLOCK6 = ipv6_groups("c_custkey % 2000", "c_custkey % 16", "c_custkey * 7 % 65536")


def hex32(groups):
    return f"array_to_string(list_transform({groups}, lambda x: lpad(lower(to_hex(x)), 4, '0')), '')"


def bits(groups):
    return f"array_to_string(list_transform({groups}, lambda x: lpad(to_binary(x), 16, '0')), '')"


def text6(groups):
    """Short text of eight groups: the first run of two or more zeros becomes `::`, by the places of its ends."""
    texts = f"list_transform({groups}, lambda x: lower(to_hex(x)))"
    starts = " ".join(f"when g[{i}] = 0 and g[{i + 1}] = 0 then {i}" for i in range(1, 8))
    ends = "coalesce(list_min(list_filter([1, 2, 3, 4, 5, 6, 7, 8], lambda i: i > a and g[i] <> 0)), 9)"
    short = "array_to_string(t[1:a - 1], ':') || '::' || array_to_string(t[b:8], ':')"
    return f"""(select case when a is null then array_to_string(t, ':') else {short} end
 from (select *, {ends} b from (select *, case {starts} end a from (select {groups} g, {texts} t))))"""


def good_event(expression):
    return f"case when event_id % 1009 = 5 then null else {expression} end"


BLOCK6_TEXT = """'2001:db8:' || lower(to_hex(c_custkey % 2000)) || '::' || lower(to_hex(c_custkey % 16)) || ':0:' || lower(to_hex(c_custkey * 7 % 65536)) || '/' || len"""
# IPv6 addresses, distinct networks and an address per prefix length in use.
SIX = f"""asked6 as (select event_id, user_id, {bits(EVENT6)} b from events where event_id % 1009 <> 5),
 nets as (select net, member, len, left(b, len) p from (select *, {bits(BLOCK6)} b, {BLOCK6_TEXT} || '-' || net member
   from (select *, [32, 44, 47, 48, 50, 64, 81, 92, 96, 128][c_custkey % 10 + 1] len, 'net_' || (c_custkey % 1000) net from customer))
  qualify row_number() over (partition by len, p order by member) = 1),
 probes as (select event_id, b, len from asked6, (select distinct len from nets))"""
EVENT6_TEXT = f"""case when e.event_id % 1009 = 5 then 'bad-ip'
  when e.event_id % 3 = 0 then array_to_string(list_transform({EVENT6.replace('event_id', 'e.event_id')}, lambda x: lpad(lower(to_hex(x)), 4, '0')), ':')
  when e.event_id % 3 = 1 then '2001:db8:' || lower(to_hex(user_id % 65536)) || '::' || lower(to_hex(e.event_id % 16)) || ':0:' || lower(to_hex(e.event_id % 65536))
  else upper(array_to_string(list_transform({EVENT6.replace('event_id', 'e.event_id')}, lambda x: to_hex(x)), ':')) end"""
MIXED = f"""with {BLOCKS}, {SIX}, best6 as (select event_id, net from probes q join nets n on q.len = n.len and left(q.b, q.len) = n.p
  where event_id % 2 = 1 qualify row_number() over (partition by event_id order by n.len desc, member) = 1),
 four as (select event_id, '10.' || (user_id % 8) || '.' || (event_id % 4 * 4) || '.' || (1 + user_id % 5 * 50) client_ip from events where event_id % 2 = 0),
 asked4 as (select distinct client_ip, {number('client_ip')} ip from four),
 best4 as (select client_ip, b.net from asked4 a join bounds4 b on a.ip between b.lo and b.hi
  qualify row_number() over (partition by client_ip order by b.m desc, b.member) = 1)
 select event_id, client_ip, net from four left join best4 using (client_ip)
 union all select e.event_id, {EVENT6_TEXT} client_ip, net from events e left join best6 using (event_id) where e.event_id % 2 = 1"""


WANTED = "target_ip in ('106.38.176.185', '106.38.176.117', '106.38.176.118', '106.38.176.116')"
PREFIX = "nullif(regexp_extract(client_ip, '^(.*)[.]', 1), '')"
PREFIXES = f"prefixes as (select seq, dns_ip, target_ip, {PREFIX} prefix from dns where {WANTED})"
COUNTS = f"{DNS}, {PREFIXES}, counts as (select target_ip, prefix, count(*) n from prefixes group by 1, 2)"


def md5_part(text, parts):
    return f"cast(('0x' || substr(md5({text}), 1, 8))::bigint % {parts} as int)"


TIMED = f"timed as (select seq, event_id, client_ip, {T} t from dns where domain like '%com' and {T} is not null)"


def stamp(t):
    return f"strftime({t}, '%Y-%m-%d %H:%M:%S')"


def hop(source, time="t", windows=4, size="2 minutes", more=""):
    """Every (window start ws, row) pair of windows that start each 30 seconds."""
    return f"""(select s.*, time_bucket(interval '30 seconds', {time}) - k * interval '30 seconds' ws
 from {source} s, generate_series(0, {windows - 1}) g(k) {more})"""


def bounds(size="2 minutes"):
    return f"{stamp('ws')} window_start, {stamp(f'ws + interval {chr(39)}{size}{chr(39)}')} window_end"


TOP10 = f"""with {DNS}, {TIMED} select {bounds()}, client_ip, count(*) n from {hop('timed')}
 group by ws, client_ip order by n desc, ws, client_ip limit 10"""
CHUNK = "cast((event_id - lo) * 4 // (hi - lo + 1) as int)"
# Rows of a batch are late against the largest time two batches earlier, less 10 seconds.
LATE = f"""with {DNS}, ends as (select min(event_id) lo, max(event_id) hi from events),
sent as (select client_ip, domain, {T} t, chunk from
  (select *, (select lo from ends) lo, (select hi from ends) hi from dns) d,
  lateral (select unnest(case when rcode = '2' then [{CHUNK}, 3] else [{CHUNK}] end) chunk)
  where domain like '%com' and {T} is not null),
marks as (select c, (select max(t) from sent where chunk <= c - 2) - interval 10 second mark from generate_series(0, 3) g(c)),
kept as (select s.*, mark from {hop('sent')} s join marks on chunk = c
  where mark is null or ws + interval 2 minute > mark)
select {bounds()}, client_ip, count(*) n from kept
where ws + interval 2 minute <= (select max(t) - interval 10 second from sent) group by ws, client_ip"""
DELIMITED = ", ".join(
    f"nullif(a[{i + 1}], '') as \"{c}\""
    for i, c in enumerate(
        ["client_ip", "domain", "time", "target_ip", "rcode", "query_type", "authority_record", "add_msg", "dns_ip"]
    )
)
CSV_ROWS = f"csvrows as (select seq, {DELIMITED} from (select seq, string_split(value, '|') a from lines))"
NORMAL = """client_ip, lower(domain) as domain, "time", target_ip, rcode, query_type,
 lower(authority_record) as authority_record, add_msg, dns_ip"""
# Files of this form do not tell an empty field from a missing one.
BLANK_NULL = ", ".join(f"nullif({c}, '') as {c}" for c in RECORD.split(", "))
ARRIVED = "arrived as (select client_ip, timestamp '2024-03-01 00:00:00' + to_seconds(event_id * 3) t from dns where domain like '%com')"

REJECTS = f"""with {LINES}, {SPLIT} select seq,
 case when seq % 107 = 3 then value else '{{"message":"' || replace(value, '|', ',') || '"}}' end as value,
 case when seq % 107 = 3 then 'no message' when len(a) <> 9 then 'field count' else 'short time' end as reason
 from split where seq % 107 = 3 or len(a) <> 9 or length(a[3]) < 8"""

COMMITTED = f"""with {DNS}, timed as (select {T} t from dns where {T} is not null)
 select strftime(h, '%Y-%m-%d') dt, strftime(h, '%H') hr, n as "rows" from (select date_trunc('hour', t) h, count(*) n from timed group by 1)
 where h + interval 1 hour <= (select max(t) - interval 10 second from timed)"""

ORACLE = {
    "parse_pipe": f"with {DNS} select seq, {RECORD} from dns",
    "parse_json": f"with {JSON_DNS} select seq, {RECORD} from jdns",
    "parse_rejects": REJECTS,
    "rejects_load": REJECTS,
    "parse_csv_ddl": f"with {LINES}, {CSV_ROWS} select *, {stamp(T)} event_time from csvrows",
    "ods_rows": f'with {DNS} select seq, {RECORD}, {PARTS} from dns where length("time") >= 8',
    "composite_id": f"with {DNS} select seq, {ID} id, {RECORD} from dns",
    "record_rename": f"with {DNS} select seq, {ID} id, {RECORD.replace(chr(34) + 'time' + chr(34), chr(34) + 'time' + chr(34) + ' as do_time')} from dns",
    "rcode_typed": f"""with {DNS} select seq, {ID} id, {RECORD.replace('rcode', 'coalesce(try_cast(rcode as int), 99) as rcode')}, {PARTS}
 from dns where length("time") >= 8""",
    "suffix_filter": f"with {DNS} select seq, {RECORD} from dns where domain like '%com'",
    "event_time": f"""with {DNS} select seq, {stamp('t')} event_time,
 {stamp("case when hour(t) = 12 then t - interval 12 hour else t end")} event_time_h12, epoch_ms(t) event_millis
 from (select seq, {T} t from dns)""",
    "csv_normalize": f"with {DNS} select {NORMAL} from dns",
    "csv_batch_write": f"with {DNS} select {BLANK_NULL} from (select {NORMAL} from dns)",
    "csv_dedup": f"with {DNS} select distinct {NORMAL} from dns",
    "ip_to_long": f"with {DNS} select seq, {number('client_ip')} ip from dns",
    "long_to_ip": """select event_id, (n >> 24) || '.' || (n >> 16) % 256 || '.' || (n >> 8) % 256 || '.' || n % 256 ip
 from (select event_id, (event_id * 2654435761 + user_id) % 4294967296 n from events)""",
    "cidr_range": f"""with {BLOCKS} select cidr, b.lo, b.hi from blocks4 left join
 (select distinct cidr, lo, hi from bounds4) b using (cidr)""",
    "mask_host_range": f"""with {DNS}, masked as (select seq, {number('client_ip')} ip, 8 + seq % 23 b from dns),
 nets as (select *, 1::bigint << cast(32 - b as int) size from masked), edges as (select *, 4294967296 - size m, ip - ip % size net from nets)
 select seq, (m >> 24) || '.' || (m >> 16) % 256 || '.' || (m >> 8) % 256 || '.' || m % 256 netmask,
 (net + 1 >> 24) || '.' || (net + 1 >> 16) % 256 || '.' || (net + 1 >> 8) % 256 || '.' || (net + 1) % 256 || '-->' ||
 (net + size - 2 >> 24) || '.' || (net + size - 2 >> 16) % 256 || '.' || (net + size - 2 >> 8) % 256 || '.' || (net + size - 2) % 256 hosts
 from edges""",
    "ipv6_hex": f"select event_id, {good_event(hex32(EVENT6))} hex from events",
    "ipv6_text": f"select event_id, {good_event(text6(EVENT6))} ip from events",
    "geo_dim_load": f"""with {GEO} select * from (select greatest(lo, coalesce(lag(hi) over (order by hi), -1) + 1) seg_lo, hi seg_hi, {LABELS} from geo)
 where seg_lo <= seg_hi""",
    "geo_enrich": f"""with {DNS}, {GEO}, {LOCATED} select seq, client_ip, {LABELS}, lower(domain) as domain, "time", target_ip, rcode,
 query_type, lower(authority_record) as authority_record, add_msg, dns_ip, {PARTS} from located where length("time") >= 8""",
    "geo_enrich_asof": f"with {DNS}, {GEO}, {LOCATED} select seq, client_ip, {LABELS} from located",
    "geo_enrich_wide": f"with {DNS}, {WIDE_GEO}, {LOCATED} select seq, client_ip, {LABELS} from located",
    "cidr_lookup": f"""with {DNS}, {BLOCKS}, asked as (select distinct client_ip, {number('client_ip')} ip from dns),
 best as (select client_ip, b.net from asked a join bounds4 b on a.ip between b.lo and b.hi
  qualify row_number() over (partition by client_ip order by b.m desc, b.member) = 1)
 select seq, client_ip, net from dns left join best using (client_ip)""",
    "cidr_lookup_nearest": f"""with {DNS}, {BLOCKS}, ends as (select * from bounds4 qualify row_number() over (partition by hi order by member) = 1),
 asked as (select seq, client_ip, {number('client_ip')} ip from dns)
 select seq, client_ip, case when lo < a.ip and a.ip < hi then net end net from asked a asof left join ends e on a.ip <= e.hi""",
    "cidr6_lookup": f"""with {SIX}, best as (select event_id, net from probes q join nets n on q.len = n.len and left(q.b, q.len) = n.p
  qualify row_number() over (partition by event_id order by n.len desc, member) = 1)
 select e.event_id, {EVENT6_TEXT} client_ip, net from events e left join best using (event_id)""",
    "cidr_mixed_lookup": MIXED,
    "cidr_mixed_stream": MIXED,
    "prefix_counts": f"with {COUNTS} select target_ip, prefix, n from counts",
    "prefix_counts_salted": f"with {COUNTS} select target_ip, prefix, n from counts",
    "prefix_map": f"""with {COUNTS}, entries as (select target_ip, coalesce(prefix, '') p, n,
  cast(ceil(count(*) over (partition by target_ip) / 10.0) as int) parts from counts)
 select target_ip, {md5_part('p', 'parts')} part, parts, string_agg(p || '=' || n, ', ' order by p) counts from entries group by 1, 2, 3""",
    "prefix_map_merged": f"with {COUNTS} select target_ip, coalesce(prefix, '') prefix, n from counts",
    "histogram_text": f"""with {COUNTS} select '(' || target_ip || ',{{' || string_agg(coalesce(prefix, '') || '=' || n, ', ' order by coalesce(prefix, '')) || '}})' as value
 from counts group by target_ip""",
    "prefix_list": f"""with {DNS}, {PREFIXES}, rows as (select seq, target_ip, coalesce(prefix, '') p,
  cast(ceil(count(*) over (partition by target_ip) / 500.0) as int) parts from prefixes)
 select target_ip, {md5_part('cast(seq as varchar)', 'parts')} part, parts, string_agg(p, ',' order by p) prefixes from rows group by 1, 2, 3""",
    "digit_partition": f"""with {COUNTS} select target_ip, cast(right(target_ip, 1) as int) % 4 "partition", count(*) prefixes,
 cast(sum(n) as bigint) requests from counts group by 1, 2""",
    "hop_count_top10": TOP10,
    "hop_count_top10_stream": TOP10,
    "hop_count_sql": f"""with {LINES}, {CSV_ROWS}, timed as (select client_ip, {T} t from csvrows where {T} is not null)
 select {bounds()}, client_ip, count(client_ip) ip_count from {hop('timed')} group by ws, client_ip
 order by ip_count desc, ws, client_ip limit 10""",
    "slide_1m_count": f"""with {DNS}, {TIMED} select {bounds('1 minute')}, client_ip, count(*) n from {hop('timed', windows=2)}
 group by ws, client_ip order by n, ws, client_ip limit 10""",
    "tumble_count": f"""with {DNS}, {TIMED}, t2 as (select client_ip, time_bucket(interval '2 minutes', t) ws from timed)
 select {bounds()}, client_ip, count(*) n from t2 group by ws, client_ip""",
    "hop_count_append": f"""with {DNS}, {TIMED} select {bounds()}, client_ip, count(*) n from {hop('timed')}
 where ws + interval 2 minute <= (select max(t) - interval 10 second from timed) group by ws, client_ip""",
    "late_data_dropped": LATE,
    "proc_window_sum": f"with {DNS}, {ARRIVED} select {bounds()}, client_ip, count(*) n from {hop('arrived')} group by ws, client_ip",
    "arrival_clock_windows": f"with {DNS} select client_ip, count(*) n from dns where domain like '%com' group by 1",
    "stream_rate_limited": f"with {DNS} select seq, {RECORD} from dns",
    "stream_table_scan": f'with {JSON_DNS} select client_ip from jdns where length("time") >= 8',
    "stream_restart": f"with {DNS} select seq, {RECORD} from dns",
    "demo_load": f"""with {JSON_DNS} select seq, {ID} id, {RECORD.replace('rcode', 'coalesce(try_cast(rcode as int), 99) as rcode')}, {PARTS}
 from jdns where length("time") >= 8""",
    "ods_load": f'with {JSON_DNS} select {RECORD}, {PARTS} from jdns where length("time") >= 8',
    "dwd_load": f"""with {JSON_DNS}, {GEO}, {LOCATED.replace('from dns)', 'from jdns)')} select client_ip, {LABELS}, lower(domain) as domain, "time", target_ip,
 rcode, query_type, lower(authority_record) as authority_record, add_msg, dns_ip, {PARTS} from located where length("time") >= 8""",
    "insert_select": f'with {DNS} select {BLANK_NULL}, substr("time", 1, 10) as "hour" from dns',
    "table_limit": f"with {DNS} select seq, {RECORD} from dns order by seq limit 3",
    "csv_sink": f"with {DNS} select {BLANK_NULL} from dns",
    "text_sink": f"""with {DNS} select '(' || concat_ws(',', {RECORD}) || ')' as value from dns""",
    "text_rolled_twice": f"""with {DNS} select '(' || concat_ws(',', {RECORD}) || ')' as value from dns""",
    "upsert_latest": f"""with {DNS} select seq, {ID} id, {RECORD} from dns qualify row_number() over (partition by {ID} order by seq desc) = 1""",
    "upsert_compacted": f"""with {DNS} select client_ip id, domain as value, seq from dns qualify row_number() over (partition by client_ip order by seq desc) = 1""",
    "upsert_two_runs": f"""with {DNS} select seq, {ID} id, {RECORD} from dns qualify row_number() over (partition by {ID} order by seq desc) = 1""",
    "partition_commit": COMMITTED,
    "partition_commit_two_runs": COMMITTED,
    "table_set_insert": f"""with {DNS} select dns_ip as "key", client_ip member, min(case when rcode = '0' then 0 else 1 end) = 1 added from dns group by 1, 2""",
    "table_delete_keys": f"""with {DNS}, r as (select seq, {ID} id, {RECORD} from dns),
 corrected as (select id from r where rcode = '3'), again as (select * from r where rcode = '3' and seq % 7 = 2),
 kept as (select * from r where id not in (select id from corrected) union all select * from again)
 select * from kept qualify row_number() over (partition by id order by seq desc) = 1""",
    "table_delete_fields": f"""with {DNS}, h as (select client_ip as "key", domain field, max(seq) "value" from dns group by 1, 2)
 select h.* from h anti join (select client_ip, domain from dns where rcode = 'NA') g on h."key" = g.client_ip and h.field = g.domain""",
    "set_insert": f"""with {DNS} select dns_ip as "key", client_ip member, min(case when rcode = '0' then 0 else 1 end) = 1 added from dns group by 1, 2""",
    "set_insert_report": f"""with {DNS}, s as (select dns_ip k, client_ip, min(case when rcode = '0' then 0 else 1 end) = 1 added from dns group by 1, 2)
 select k as "key", count(*) filter (added) n_added, count(*) filter (added) > 0 any_added from s group by 1""",
    "set_members": f"""with {DNS} select distinct client_ip as "key", domain member from dns
 where client_ip in (select client_ip from dns where rcode = 'NA')""",
    "delete_keys": f"""with {DNS}, r as (select seq, {ID} id, {RECORD} from dns)
 select * from r where id not in (select id from r where rcode = '3')""",
    "delete_fields": f"""with {DNS}, h as (select client_ip as "key", domain field, max(seq) "value" from dns group by 1, 2)
 select h.* from h anti join (select client_ip, domain from dns where rcode = 'NA') g on h."key" = g.client_ip and h.field = g.domain""",
    "domain_mismatch": f"with {DNS} select seq, {RECORD} from dns where authority_record <> '' and lower(domain) <> lower(authority_record)",
    "rcode_counts": f"with {DNS} select rcode, count(*) n from dns group by 1",
    "clients_per_resolver": f"with {DNS} select dns_ip, count(distinct client_ip) clients, count(*) requests from dns group by 1",
}
