"""SQL fragments for the oracles, in DuckDB's dialect."""

from registry.views import AS_OF, FILES_SQL, PARENTS_SQL, RAW_SQL

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)"
NUMBER = r"^[+-]?(\d+(_?\d+)*\.?(\d+(_?\d+)*)?|\.\d+(_?\d+)*)([eE][+-]?\d+(_?\d+)*)?$"
KEYS = "file_id, ln, pk, sk, arrived"


def number(text: str) -> str:
    return f"case when regexp_matches({text}, '{NUMBER}') then cast(replace({text}, '_', '') as double) end"


def whole(text: str, kind: str = "bigint") -> str:
    return f"try_cast(trunc({number(text)}) as {kind})"


def kg(text: str) -> str:
    return f"try_cast(({number(text)}) as decimal(10,3))"


def strip(c: str) -> str:
    return f"trim({c}, {SPACE})"


def unitless(text: str) -> str:
    return strip(f"replace({text}, 'kg', '')")


def flag(text: str) -> str:
    return (
        f"case when upper({text}) in ('Y','YES','TRUE','1') then true "
        f"when upper({text}) in ('N','NO','FALSE','0') then false end"
    )


def utc(text: str) -> str:
    return rf"try_strptime(regexp_replace({text}, '\s+', ' ', 'g'), '%Y-%m-%d %H:%M:%S') - interval 2 hour"


def ratio(part: str, whole_: str, places: int, factor: int = 1) -> str:
    """Exact half-up quotient of two whole numbers of at least zero, in integers."""
    p = 10**places
    a, n = f"cast({part} as hugeint) * {factor * p}", f"cast({whole_} as hugeint)"
    return (
        f"case when {whole_} <> 0 then cast((2 * {a} + {n}) // (2 * {n}) as decimal(38,0)) / {p}.0 end"
    )


def decimal(expr: str, places: int) -> str:
    return f"cast({expr} as decimal(18,{places}))"


def mean_kg(kept: str, places: int) -> str:
    milli = f"sum(cast({kept} * 1000 as bigint))"
    return decimal(ratio(milli, f"(count({kept}) * 1000)", places), places)


def percent(part: str, whole_: str, places: int) -> str:
    return decimal(ratio(part, whole_, places, 100), places)


def count_if(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


RAW = f"raw as ({RAW_SQL})"
_CELLS = {
    "transact_raw": "tn", "scale_raw": "sn", "cyl_raw": "cy", "tare_raw": "ta", "fill_raw": "fi",
    "residual_raw": "re", "success_raw": "su", "started_raw": "dt", "fill_time_raw": "ft",
}
STRIPPED = f"stripped as (select *, {', '.join(f'{strip(c)} as {a}' for c, a in _CELLS.items())} from raw)"
VALUED = f"""valued as (select *, {whole('tn')} as transact_no, nullif(sn, '') as scale_name,
  {kg('cy')} as cyl_size_kg, {kg(unitless('ta'))} as tare_weight_kg, {kg(unitless('fi'))} as fill_kg,
  {kg(unitless('re'))} as residual_kg, {flag('su')} as success, {utc('dt')} as started_at,
  {whole('ft', 'integer')} as fill_time_seconds from stripped)"""
JUDGED = f"""judged as (select *, case when transact_no is null then 0 when scale_name is null then 1
  when cyl_size_kg is null and cy <> '' then 2
  when tare_weight_kg is null and {unitless('ta')} <> '' then 3
  when fill_kg is null and {unitless('fi')} <> '' then 4
  when residual_kg is null and {unitless('re')} <> '' then 5
  when success is null then 6 when started_at is null then 7 when fill_time_seconds is null then 8
  when transact_no <= 0 then 9 when fill_time_seconds < 0 then 10 end as rule from valued)"""
VALUES = (
    "transact_no, scale_name, cyl_size_kg, tare_weight_kg, fill_kg, residual_kg, success, "
    "started_at, fill_time_seconds"
)
FIELDS = (
    "['TransactNo','Scale Name','CylSize','TareWeight','Fill kgs','Residual','Success',"
    "'Date Time Start','Fill Time','transact_no','fill_time_seconds']"
)
VALID = f"valid as (select {KEYS}, {VALUES} from judged where rule is null)"
BAD = f"""bad as (select {KEYS}, {FIELDS}[rule + 1] as field,
  case when rule in (0, 8) and (case rule when 0 then tn else ft end) = '' then 'REQUIRED'
       when rule = 1 or (rule = 6 and su = '') or (rule = 7 and dt = '') then 'REQUIRED'
       when rule >= 9 then 'CONSTRAINT' else 'INVALID' end as code,
  case rule when 0 then transact_raw when 1 then scale_raw when 2 then cyl_raw when 3 then tare_raw
    when 4 then fill_raw when 5 then residual_raw when 6 then success_raw when 7 then started_raw
    when 8 then fill_time_raw when 9 then transact_raw else fill_time_raw end as raw_value,
  case rule
    when 0 then 'Invalid TransactNo: ''' || transact_raw || ''' - ' || case when tn = '' then 'TransactNo is required'
      else 'could not convert string to float: ''' || tn || '''' end
    when 1 then 'Scale Name is required'
    when 2 then 'Invalid CylSize: ''' || cyl_raw || ''''
    when 3 then 'Invalid TareWeight: ''' || tare_raw || ''' - expected numeric value'
    when 6 then 'Invalid Success: ''' || success_raw || ''' - expected Y/N or True/False'
    when 7 then 'Invalid Date Time Start: ''' || started_raw || ''' - expected format ''YYYY-MM-DD HH:MM:SS'''
    when 9 then 'Transaction number must be positive'
    when 10 then 'Fill time cannot be negative' end as detail
  from judged where rule is not null)"""
NORM = ", ".join([RAW, STRIPPED, VALUED, JUDGED, VALID, BAD])
HISTORY = "arrived desc, pk desc, sk desc, ln desc, file_id desc"
CURRENT = f"""current as (select * exclude (place, file_id), file_id as ingestion_file_id from (select *,
  row_number() over (partition by scale_name, transact_no order by {HISTORY}) as place,
  cast(min(arrived) over (partition by scale_name, transact_no) as timestamp) as created_at,
  cast(max(arrived) over (partition by scale_name, transact_no) as timestamp) as updated_at
  from valid) where place = 1)"""
FILES = f"files as ({FILES_SQL.replace('make_interval_seconds(event_id % 300)', 'to_seconds(event_id % 300)')})"
PARENTS = f"parents as ({PARENTS_SQL})"
NOW = f"timestamp '{AS_OF}'"


def norm(select: str, *more: str) -> str:
    return f"with {', '.join([NORM, *more])} {select}"


def current(select: str, *more: str) -> str:
    return norm(select, CURRENT, *more)


def files(select: str) -> str:
    return f"with {FILES} {select}"


def uuid_of(identity: str) -> str:
    cut = lambda a, n: f"substr(sha256({identity}), {a}, {n})"
    return " || '-' || ".join([cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)])
