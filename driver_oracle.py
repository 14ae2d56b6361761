"""SQL giving the rows of each driver query, over the driver's tables as views."""

from __future__ import annotations

from waybill.plans.specs import CARDS, EMPLOYEES, MACHINES

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice"


def quoted(expression: str) -> str:
    return f"'''' || {expression} || ''''"


def number(column: str) -> str:
    whole = f"cast(cast({column} as bigint) as varchar)"
    return quoted(f"case when {column} = floor({column}) then {whole} else cast({column} as varchar) end")


def date(column: str) -> str:
    return quoted(f"strftime({column}, '%d.%m.%Y')")


def statement(table: str, spec: list, values: dict) -> str:
    """INSERT text: `values` maps columns to literal expressions, the others are null."""
    names = ", ".join(n for n, _ in spec)
    literals = " || ',' || ".join(f"coalesce({values[n]}, 'null')" if n in values else "'null'" for n, _ in spec)
    return f"'INSERT INTO {table} ({names}) VALUES (' || {literals} || ');'"


def stop_findings(stops: str, coords: bool) -> str:
    """Findings of the stop audit over a query giving archive_id, rec_no, NAZWA, KOD2, SYM, X_KRAJ, Y_KRAJ."""
    missing = (
        "select archive_id, 'no_{rule}' as rule, rec_no, KOD2 as key, cast(null as bigint) as members, "
        "'Przystanek [' || NAZWA || '] [' || KOD2 || '] nie ma przypisan{what}.' as message from kept where {test}"
    )
    parts = [
        "select archive_id, case when same then 'same_name_and_code' else 'same_name' end as rule, rec_no, "
        "name_key as key, k as members, 'Przystanki ' || f || ', [' || NAZWA || '] [' || KOD2 || '] ' || case when same "
        "then 'mają taką samą nazwę i kod.' else 'mają taką samą nazwę.' end as message from named where k > 1",
        "select archive_id, 'same_code' as rule, rec_no, KOD2 as key, k2 as members, 'Przystanki ' || f2 || ', [' || "
        "NAZWA || '] [' || KOD2 || '] mają taki sam kod.' as message from coded where k2 > 1",
        missing.format(rule="administration", what="ej administracji", test="SYM is null or trim(SYM) = ''"),
    ]
    if coords:
        test = "X_KRAJ is null or trim(X_KRAJ) = '' or Y_KRAJ is null or trim(Y_KRAJ) = ''"
        parts.append(missing.format(rule="coordinates", what="ych współrzędnych", test=test))
    return f"""
with stops as ({stops}),
named as (select *, row_number() over w as k,
 first_value('[' || NAZWA || '] [' || KOD2 || ']') over w as f,
 count(*) over (partition by archive_id, name_key) > 1 and
 first_value(KOD2) over (w rows between unbounded preceding and unbounded following) is not distinct from
 nth_value(KOD2, 2) over (w rows between unbounded preceding and unbounded following) as same
 from (select *, upper(NAZWA) as name_key from stops) window w as (partition by archive_id, name_key order by rec_no)),
kept as (select * from named where not same),
coded as (select *, row_number() over w as k2, first_value('[' || NAZWA || '] [' || KOD2 || ']') over w as f2
 from kept window w as (partition by archive_id, KOD2 order by rec_no)),
found as ({" union all ".join(parts)})
"""


MAPPED_STOPS = """
select 'a' || (p_size % 5) as archive_id, p_partkey as rec_no, p_name || ' ' || p_size as NAZWA,
 p_brand || '/' || p_size as KOD2, case when p_partkey % 7 <> 0 then p_type end as SYM,
 case when p_partkey % 11 <> 0 then '1' else '  ' end as X_KRAJ, case when p_partkey % 13 <> 0 then '1' end as Y_KRAJ from part
"""

PACKED = """
select printf('a%07d.zip', p_partkey // 500) as archive_id, p_partkey // 500 as number,
 row_number() over (partition by p_partkey // 500 order by p_partkey) as rec_no, p_partkey as key, p_name, p_type, p_size,
 p_name || ' żółć ' || p_size as NAZWA, p_brand || '/' || p_size as KOD2,
 case when p_partkey % 7 <> 0 then p_type else '' end as SYM, p_retailprice from part
"""
PACKED_STOPS = f"select archive_id, rec_no, NAZWA, KOD2, SYM, '' as X_KRAJ, '' as Y_KRAJ from ({PACKED})"
PACKED_ARCHIVES = f"select distinct archive_id, number from ({PACKED})"

ROUTE_MESSAGE = (
    "'[' || carrier || '] {kind} ' || number || ' (' || status || '), wariant 1, ważn{end} od ' || {day} || "
    "', przystanek [ ' || prev_name || ' ], kod2: [ ' || code || ' ] następuje jeden po drugim.'"
)

LINE_ROWS = """
select 'a' || (l_orderkey % 3) as archive_id, l_partkey * 10000000 + l_suppkey as rec_no,
 cast(l_orderkey % 5 as integer) as carrier, cast(l_orderkey as integer) as number, l_linenumber as seq, l_suppkey as code,
 'P' || l_partkey as name, o_orderstatus, o_orderpriority, o_orderdate
from lineitem join orders on l_orderkey = o_orderkey
where o_orderpriority = '5-LOW' or o_orderdate > timestamp '1996-01-01'
"""

COURSE_LABEL = (
    "case stat when 1 then 'projektowany' when 2 then 'aktywny' when 3 then 'zawieszony' when 4 then 'zlikwidowany' else 'bd' end"
)


def course_findings(partition: str, order: str) -> str:
    return f"""
with courses as (select user_id as owner, cast(ts as date) as from_day, arg_min(event_id % 5, event_id) as stat from events
 where event_type = 'view' group by all),
routes as (select 'a' || (user_id % 3) as archive_id, event_id as rec_no, user_id % 4 as carrier,
 cast(user_id as integer) as number, cast(ts as date) as day, date_trunc('second', ts) as edited,
 cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as integer) as seq,
 case when event_type <> 'click' then length(event_type) else -1 end as code, event_type as name, {COURSE_LABEL} as status
 from events join courses on user_id = owner and cast(ts as date) = from_day),
paired as (select *, lag(seq) over w as prev_seq, lag(code) over w as prev_code, lag(name) over w as prev_name,
 lag(day) over w as prev_day from routes window w as (partition by {partition} order by {order}))
select archive_id, rec_no, number, day as valid_from, seq, cast(code as varchar) as code, status,
 {ROUTE_MESSAGE.format(kind="Kurs", end="y", day="strftime(day, '%Y-%m-%d')")} as message
from paired where seq > prev_seq and code = prev_code and day = prev_day
"""


MACHINE_ROWS = """
select 'a' || (user_id % 3) as archive_id, event_id as rec_no, 'K' || user_id as logo, event_id, ts, props, event_type,
 case when event_type = 'error' then 'EMAR-105' else 'OTHER' end as typbil,
 case when value > 1 then cast(cast(value as decimal(10,2)) as varchar) end as werpsb
from events where cast(ts as date) >= date '2024-01-16' and user_id % 10 <> 0
"""
MACHINE_STATEMENT = statement(
    "IMP_KasyFiskalne", MACHINES,
    {"LOGO": quoted("logo"), "NRFABR": quoted("event_id"), "DATAPROD": date("ts"), "TYPBIL": quoted("typbil"),
     "DATAZORF": date("ts"), "UWAGI": quoted("replace(trim(props), '''', '''''')"), "WERPSB": quoted("werpsb")},
)
MACHINE_SCRIPT = f"select archive_id, 'KasyFiskalne' as script, rec_no, {MACHINE_STATEMENT} as stmt from ({MACHINE_ROWS})"

EMPLOYEE_STATEMENT = statement(
    "IMP_Pracownicy", EMPLOYEES,
    {"NR_SLUZB": quoted("c_custkey"), "IMIE": quoted("trim(c_name)"), "NAZWISKO": quoted("trim(c_mktsegment)"),
     "STATUS": quoted("case when c_nationkey % 10 = 7 then '7' else '8' end"), "ETAT": number("c_acctbal")},
)
EMPLOYEE_SCRIPT = (
    f"select 'a' || (c_custkey % 3) as archive_id, 'Pracownicy' as script, c_custkey as rec_no, {EMPLOYEE_STATEMENT} as stmt "
    "from customer"
)

CARD_STATEMENT = statement(
    "IMP_KartyPamieci", CARDS,
    {"NRKP": quoted("o_orderkey"), "DATAPROD": date("o_orderdate"), "POJEMN": number("o_totalprice"),
     "TYP": quoted("trim(o_orderpriority)"), "STATUS": quoted("trim(o_orderstatus)"), "DATAREJ": date("o_orderdate")},
)
CARD_SCRIPT = (
    f"select 'a' || (o_custkey % 3) as archive_id, 'KartyPamieci' as script, o_orderkey as rec_no, {CARD_STATEMENT} as stmt "
    "from orders"
)

PACKED_STATEMENT = statement(
    "IMP_Pracownicy", EMPLOYEES,
    {"NR_SLUZB": quoted("key"), "IMIE": quoted("'Świętosław ' || p_name"), "NAZWISKO": quoted("p_type"),
     "STATUS": quoted("case when p_size % 10 = 7 then '7' else '8' end"), "DATA_PRZYJ": "'''29.02.2020'''"},
)
SCRIPT_FILE = "'Łódź ' || number || '_' || replace(archive_id, '.zip', '') || '_import_danych_startowych/import_Pracownicy.sql'"

PART_WINDOW = "window w as (partition by upper(p_name), p_size order by p_partkey"
FULL = "rows between unbounded preceding and unbounded following"
DEVICES = "select event_id, user_id, event_type, case when value < 2 then null else value end as v from events"

# Archives of timetables and devices: those of odd number have text fields, and other forms of numbers and dates.
TIMETABLE = "printf('t%05d.zip', {key} // {per})"
LINE_ARCHIVE, EVENT_ARCHIVE = TIMETABLE.format(key="l_orderkey", per=2000), TIMETABLE.format(key="user_id", per=20)
PLACE = "row_number() over (partition by {key} // {per} order by {order})"
FILED_LINES = f"""
select *, {LINE_ARCHIVE} as archive_id, (l_orderkey // 2000) % 2 = 1 as odd,
 {PLACE.format(key="l_orderkey", per=2000, order="l_orderkey, " + LINE_ORDER)} as rec_no from lineitem
"""
FILED_EVENTS = f"select *, {EVENT_ARCHIVE} as archive_id, (user_id // 20) % 2 = 1 as odd, {PLACE.format(key='user_id', per=20, order='event_id')} as rec_no from events"
FOUND_LINES = f"""
select archive_id, 'lines' as section, rec_no, carrier, number, seq, cast(code as varchar) as code, status,
 {ROUTE_MESSAGE.format(kind="Linia", end="a", day="'1995-03-01'")} as message from (
select *, case o_orderstatus when 'F' then 'aktywna' when 'O' then 'projektowana' else 'zawieszona' end as status,
 lag(seq) over w as prev_seq, lag(code) over w as prev_code, lag(name) over w as prev_name from (
 select archive_id, rec_no, cast(l_orderkey % 5 as integer) as carrier, cast(l_orderkey as integer) as number, l_linenumber as seq,
  l_suppkey as code, 'P' || l_partkey as name, o_orderstatus from ({FILED_LINES}) join orders on l_orderkey = o_orderkey
  where l_suppkey % 50 <> 0 and (o_orderpriority = '5-LOW' or cast(o_orderdate as date) > date '1996-01-01'))
window w as (partition by number order by seq, rec_no)) where seq > prev_seq and code = prev_code
"""
FOUND_COURSES = f"""
select archive_id, 'courses' as section, rec_no, carrier, number, seq, cast(code as varchar) as code, status,
 {ROUTE_MESSAGE.format(kind="Kurs", end="y", day="strftime(day, '%Y-%m-%d')")} as message from (
select *, lag(seq) over w as prev_seq, lag(code) over w as prev_code, lag(name) over w as prev_name from (
 select archive_id, rec_no, cast(user_id % 4 as integer) as carrier, cast(user_id as integer) as number, cast(ts as date) as day,
  cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as integer) as seq,
  case when event_type <> 'click' then length(event_type) else -1 end as code, event_type as name, {COURSE_LABEL} as status
 from ({FILED_EVENTS}) join (select user_id as owner, cast(ts as date) as from_day,
  arg_min(case when event_type = 'view' then event_id % 5 end, event_id) filter (event_type = 'view') as first_view,
  case when arg_min(event_type, event_id) = 'view' then arg_min(event_id % 5, event_id) end as stat from events group by all)
 on user_id = owner and cast(ts as date) = from_day where stat is not null)
window w as (partition by number, day order by seq, rec_no)) where seq > prev_seq and code = prev_code
"""
PLAIN_NUMBER = "case when contains({0}, '.') then rtrim(rtrim({0}, '0'), '.') else {0} end"
FILED_MACHINES = f"""
select archive_id, 'KasyFiskalne' as script, rec_no, {MACHINE_STATEMENT} as stmt from (select *, 'K' || user_id as logo,
 case when event_type = 'error' then 'EMAR-105' else 'OTHER' end as typbil,
 case when odd then {PLAIN_NUMBER.format("version")} else coalesce(version, '') end as werpsb from (select * exclude (props), substr(props, 1, 60) as props,
  case when value > 1 then cast(cast(value as decimal(10,2)) as varchar) end as version from ({FILED_EVENTS})))
where cast(ts as date) >= date '2024-01-16' and user_id % 10 <> 0
"""
FILED_EMPLOYEES = f"""
select printf('t%05d.zip', c_custkey // 200) as archive_id, 'Pracownicy' as script,
 {PLACE.format(key="c_custkey", per=200, order="c_custkey")} as rec_no, {EMPLOYEE_STATEMENT} as stmt from customer
"""
FILED_CARDS = f"""
select printf('t%05d.zip', o_orderkey // 2000) as archive_id, 'KartyPamieci' as script,
 {PLACE.format(key="o_orderkey", per=2000, order="o_orderkey")} as rec_no, {CARD_STATEMENT} as stmt from orders
"""

REPORT_HEAD = (
    "'01/12/2026 08:30' || chr(10) || 'Parametry weryfikacji:' || chr(10) || chr(10) || chr(9) || 'Firma: Łódź ' || number || chr(10) || "
    "chr(9) || 'Sprawdź współrzędne przystanków: nie' || chr(10) || chr(9) || 'Sprawdź administrację przystanków: tak' || chr(10) || chr(9) || "
    "'Sprawdź linie/kursy firm obcych: tak' || chr(10) || chr(9) || 'Linie/kursy: tylko aktywne, data ważności do > 01/01/2018 lub pole puste' || chr(10)"
)
REPORT_RULE = "case rule when 'same_name' then 1 when 'same_name_and_code' then 1 when 'same_code' then 2 else 3 end"
REPORT_PIECES = f"""
select archive_id, -1 as section, 0 as step, 0 as rule_no, null as sort, 0 as rec_no, {REPORT_HEAD} as text from ({PACKED_ARCHIVES})
union all select archive_id, 0, 0, 0, null, 0, chr(10) || chr(10) || 'Przystanki: ' || count(*) || chr(10) from stops group by archive_id
union all select archive_id, 0, 1, {REPORT_RULE}, case when rule <> 'no_administration' then key end, rec_no, chr(10) || chr(9) || message || chr(10) from found
union all select a.archive_id, 0, 2, 0, null, 0, case when n = 0 then chr(10) || chr(9) || 'Nie znaleziono błędów.' || chr(10)
 else chr(10) || chr(10) || chr(9) || 'Znaleziono błędów: ' || n || chr(10) end from (
 select archive_id, (select count(*) from found f where f.archive_id = p.archive_id) as n from ({PACKED_ARCHIVES}) p) a
union all select archive_id, no, 0, 0, null, 0, chr(10) || chr(10) || head || ': 0' || chr(10)
 from ({PACKED_ARCHIVES}) cross join (values (1, 'Linie'), (2, 'Kursy')) t(no, head)
union all select archive_id, no, 1, 9, name, 0, chr(10) || chr(9) || 'Archiwum nie zawiera tabeli ' || name || '.' || chr(10)
 from ({PACKED_ARCHIVES}) cross join (values (1, 'linie'), (1, 'trasylinii'), (2, 'kursy'), (2, 'trasykursow')) t(no, name)
union all select archive_id, no, 2, 0, null, 0, chr(10) || chr(9) || 'Nie sprawdzono żadnych danych.' || chr(10)
 from ({PACKED_ARCHIVES}) cross join (values (1), (2)) t(no)
"""

ORACLES = {
    "duplicate_name_groups": """
select upper(p_name) as name_key, p_size as part_size, count(*) as members, count(*) - 1 as findings, min(p_partkey) as first_rec
from part group by upper(p_name), p_size having count(*) > 1""",
    "duplicate_name_findings": f"""
select name_key, p_size as part_size, k, code1 is not distinct from code2 as same_code,
 upto as members from (
select upper(p_name) as name_key, p_size, row_number() over w as k,
 first_value(p_brand) over (w {FULL}) as code1, nth_value(p_brand, 2) over (w {FULL}) as code2,
 string_agg('[' || p_name || '] [' || p_brand || ']', ', ') over (w rows between unbounded preceding and current row) as upto
from part {PART_WINDOW})) where k >= 2""",
    "duplicate_code_findings": f"""
with s as (select *, count(*) over (partition by upper(p_name), p_size) as n, first_value(p_brand) over w as c1,
 nth_value(p_brand, 2) over w as c2 from part {PART_WINDOW} {FULL})),
kept as (select * from s where not (n > 1 and c1 is not distinct from c2))
select p_brand as code, p_size as part_size, count(*) as members, count(*) - 1 as findings from kept
where p_brand is not null group by p_brand, p_size having count(*) > 1""",
    "missing_admin_findings": """
select d.doc_id as doc_id, d.source as source from documents d left join labels l on d.doc_id = l.doc_id
where l.quality is null or trim(cast(l.quality as varchar)) = ''""",
    "missing_coords_findings": """
select doc_id from (select d.doc_id, nullif(d.lang, 'en') as x, case when l.toxic = 1 then null else l.toxic end as y
from documents d left join labels l on d.doc_id = l.doc_id) where x is null or trim(x) = '' or y is null""",
    "active_lines": """
select o_orderkey, o_custkey from (select *, case when o_orderpriority = '5-LOW' then null else o_orderdate end as valid_to
from orders) where o_orderstatus = 'F' and o_custkey % 2 = 0 and (valid_to is null or valid_to > timestamp '1998-01-01')""",
    "trip_first_match": """
with l as (select o_custkey, o_orderpriority, o_orderstatus, row_number() over (partition by o_custkey, o_orderpriority
 order by o_orderkey) as rn from orders where o_orderstatus <> 'P')
select t.o_orderkey as o_orderkey, l.o_orderstatus as matched_status from orders t join l
on t.o_custkey is not distinct from l.o_custkey and t.o_orderpriority is not distinct from l.o_orderpriority and l.rn = 1
where t.o_orderstatus = 'P'""",
    "line_consecutive_stops": f"""
select l_orderkey, l_linenumber, l_suppkey, prev_part, case o_orderstatus when 'O' then 'projektowana' when 'F' then 'aktywna'
 when 'P' then 'zawieszona' else 'bd' end as status_name from (
select l.*, o.o_orderstatus, lag(l_suppkey) over w as prev_stop, lag(l_linenumber) over w as prev_seq,
 lag(l_partkey) over w as prev_part from lineitem l join orders o on l_orderkey = o_orderkey
 where o.o_orderdate > timestamp '1996-01-01' window w as (partition by l_orderkey order by {LINE_ORDER}))
where l_linenumber > prev_seq and l_suppkey is not distinct from prev_stop""",
    "course_consecutive_stops": """
select user_id, event_id, event_type, prev_value from (select *, lag(event_type) over w as prev_type,
 lag(cast(ts as date)) over w as prev_day, lag(value) over w as prev_value from events
 window w as (partition by user_id order by ts, event_id)) where cast(ts as date) = prev_day and event_type = prev_type""",
    "sequence_groups": f"""
select l_orderkey, count(*) as rows_in_order, cast(sum(brk) as bigint) as group_count from (select l_orderkey,
 case when lag(l_linenumber) over w is null or l_linenumber <= lag(l_linenumber) over w then 1 else 0 end as brk
 from lineitem window w as (partition by l_orderkey order by {LINE_ORDER})) group by l_orderkey""",
    "device_recency": """
select event_id from events where ts is not null and ts >= timestamp '2024-01-30 23:57:12' - interval '7' day
and not (event_type = '')""",
    "device_version_findings": f"""
select event_id, case when v is null then 'missing' else 'too_old' end as finding from ({DEVICES})
where event_type = 'error' and (v is null or v < 5)""",
    "device_version_flag": f"""
select user_id, bool_or(v is not null) as any_too_old from ({DEVICES}) where event_type = 'error' and (v is null or v < 5)
group by user_id""",
    "status_default": """
select event_id, case when event_type in ('click', 'view') then event_type else 'view' end as status from events""",
    "sql_literals": f"""
select o_orderkey, coalesce({date("o_orderdate")}, 'null') as d_lit, coalesce({number("o_totalprice")}, 'null') as n_lit,
 coalesce({quoted("trim(o_orderpriority)")}, 'null') as s_lit from orders""",
    "insert_statements": f"""
select s_suppkey, 'INSERT INTO IMP_S (K, N, A) VALUES (' || {quoted("s_suppkey")} || ',' ||
 {quoted("replace(trim(s_name), '''', '''''')")} || ',' || {number("s_acctbal")} || ');' as stmt from supplier""",
    "audit_summary": """
select 'parts' as section, count(*) as checked, (select cast(coalesce(sum(n - 1), 0) as bigint) from (select count(*) as n
 from part group by upper(p_name), p_size having count(*) > 1)) as errors from part
union all select 'orders', count(*), cast(sum(case when o_orderstatus = 'P' then 1 else 0 end) as bigint) from orders""",
    "stop_audit": stop_findings(MAPPED_STOPS, True) + "select *, cast(1 as bigint) as errors from found",
    "findings_table": stop_findings(MAPPED_STOPS, False) + "select 'stops' as section, *, cast(1 as bigint) as errors from found",
    "matched_line_routes": f"""
select archive_id, rec_no, cast(carrier as varchar) as NRF, cast(number as bigint) as NRLINII, seq as NRPRZYST, code as KOD2,
 name as NAZPRZYST, case o_orderstatus when 'F' then '2' when 'O' then '1' else '3' end as STATLINII from ({LINE_ROWS})""",
    "line_audit": f"""
select archive_id, rec_no, carrier, number, seq, status,
 {ROUTE_MESSAGE.format(kind="Linia", end="a", day="'0001-01-01'")} as message from (
select *, case o_orderstatus when 'F' then 'aktywna' when 'O' then 'projektowana' else 'zawieszona' end as status,
 lag(seq) over w as prev_seq, lag(code) over w as prev_code, lag(name) over w as prev_name from ({LINE_ROWS})
window w as (partition by number order by seq, rec_no)) where seq > prev_seq and code = prev_code""",
    "course_audit": course_findings("number, day", "seq, rec_no"),
    "course_audit_by_edit_time": course_findings("number", "edited, seq, rec_no"),
    "timetable_rejects": f"""
select archive_id, 'trasylinii' as "table", 'KOD2' as "column", 'x' as value, count(*) as rows from ({LINE_ROWS})
where o_orderstatus = 'F' and code % 50 = 0 group by archive_id""",
    "machine_import": MACHINE_SCRIPT,
    "machine_findings": f"""
select archive_id, rec_no, case when werpsb is null then 'version_missing' else 'version_too_old' end as rule,
 'Bileterka EMAR-105 ' || logo || case when werpsb is null then ' nie ma wersji oprogramowania!'
 else ' ma wersję oprogramowania ' || werpsb || '!' end as message from ({MACHINE_ROWS})
where event_type = 'error' and (werpsb is null or cast(werpsb as double) < 1.5)""",
    "employee_import": EMPLOYEE_SCRIPT,
    "card_import": CARD_SCRIPT,
    "script_counts": f"""
select archive_id, script, count(*) as rows from (select archive_id, script from ({MACHINE_SCRIPT}) union all
select archive_id, script from ({EMPLOYEE_SCRIPT}) union all select archive_id, script from ({CARD_SCRIPT}))
group by archive_id, script""",
    "archive_members": f"""
select archive_id, member, "table" from ({PACKED_ARCHIVES}) cross join (values ('info/ArchiwumInfo_1.rtf', null),
 ('bazy/PRZYSTANKI.dbf', 'przystanki'), ('bazy/Pracownicy.DBF', 'pracownicy')) m(member, "table")""",
    "archive_scan": f"""
select archive_id, rec_no, NAZWA as name, KOD2 as code, SYM as sym,
 case when key % 11 <> 0 then cast(cast(p_retailprice as decimal(10,2)) as double) end as x,
 cast((key % 100) || '.5' as double) as y, case when key % 3 <> 0 then '2024-01-31' end as valid_from,
 key % 2 = 0 as active from ({PACKED})""",
    "archive_columns": f"select archive_id, rec_no, KOD2 as code from ({PACKED})",
    "manifest": f"""
select archive_id, 'Łódź ' || number as company, 'Dane firmy: Łódź ' || number as company_line,
 'Licencja: L-1' as licence_line from ({PACKED_ARCHIVES})""",
    "archive_audit": stop_findings(PACKED_STOPS, False) + f"""
select a.archive_id, section, case when section = 'stops' then n else 0 end as checked,
 case when section = 'stops' then errors else 0 end as errors, case when section = 'stops' then errors = 0 end as clean from (
select archive_id, count(*) as n, (select count(*) from found f where f.archive_id = s.archive_id) as errors from stops s
group by archive_id) a cross join (values ('stops'), ('lines'), ('courses')) t(section)""",
    "archive_audit_findings": stop_findings(PACKED_STOPS, False) + f"""
select archive_id, 'stops' as section, rule, rec_no, message from found
union all select archive_id, section, 'missing_table', null, 'Archiwum nie zawiera tabeli ' || name || '.' from ({PACKED_ARCHIVES})
cross join (values ('linie', 'lines'), ('trasylinii', 'lines'), ('kursy', 'courses'), ('trasykursow', 'courses')) t(name, section)""",
    "script_files": f"""
select {SCRIPT_FILE} as file, {PACKED_STATEMENT} as line from ({PACKED})
union all select {SCRIPT_FILE}, line from ({PACKED_ARCHIVES})
cross join (values ('-- dane początkowe'), ('--START'), ('--KONIEC'), ('COMMIT;')) t(line)""",
    "archive_route_findings": f"select * from ({FOUND_LINES}) union all select * from ({FOUND_COURSES})",
    "archive_rejects": f"""
select archive_id, 'trasylinii' as "table", rec_no, 'KOD2' as "column", case when odd then 'x' else '*****' end as value
 from ({FILED_LINES}) join orders on l_orderkey = o_orderkey where l_suppkey % 50 = 0
 and (not odd or o_orderpriority = '5-LOW' or cast(o_orderdate as date) > date '1996-01-01')
union all select archive_id, 'trasykursow', rec_no, 'STATKURSU', null from ({FILED_EVENTS}) join (select user_id as owner,
 cast(ts as date) as from_day, arg_min(event_type, event_id) as first_type from events group by all)
 on user_id = owner and cast(ts as date) = from_day where first_type <> 'view'""",
    "archive_scripts": f"{FILED_MACHINES} union all {FILED_EMPLOYEES} union all {FILED_CARDS}",
    "report_files": stop_findings(PACKED_STOPS, False) + f"""
, pieces as ({REPORT_PIECES}),
reports as (select archive_id, string_split(string_agg(text, '' order by section, step, rule_no, sort nulls first, rec_no), chr(10)) as lines
 from pieces group by archive_id)
select 'Łódź ' || cast(substr(archive_id, 2, 7) as integer) || '_' || replace(archive_id, '.zip', '') || '_011220260830.txt' as file,
 cast(unnest(range(0, len(lines))) as integer) as place, unnest(lines) as line from reports""",
}
