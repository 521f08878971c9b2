"""The queries again as plain SQL, to check the Spark results against.

Each text names the views it needs; ``statement`` puts them in front as CTEs.
"""

from __future__ import annotations

import re

VIEWS = {
    "role_artist": """
select distinct n_nationkey as ArtistId, concat(' ', n_name, ' ') as Name
  from supplier join nation on s_nationkey = n_nationkey""",
    "role_album": """
select cast(s_suppkey as int) as AlbumId, s_name as Title, s_nationkey as ArtistId
  from supplier""",
    "role_genre": """
select cast(row_number() over (order by p_type) as int) as GenreId, p_type as Name
  from (select distinct p_type from part) t""",
    "role_mediatype": """
select distinct cast(split_part(p_brand, '#', 2) as int) as MediaTypeId, p_brand as Name
  from part""",
    "role_track": """
select cast(p_partkey as int) as TrackId, p_name as Name
     , cast(p_partkey % 10 as int) as AlbumId
     , cast(split_part(p_brand, '#', 2) as int) as MediaTypeId, g.GenreId as GenreId
     , case when p_partkey % 4 = 0 then null else p_brand end as Composer
     , p_size * 1000 as Milliseconds, p_size * 4096 as Bytes
     , cast(p_retailprice as decimal(10,2)) as UnitPrice
  from part join role_genre g on p_type = g.Name""",
    "role_employee": """
select cast(s_suppkey as int) as EmployeeId, split_part(s_name, '#', 1) as FirstName
     , split_part(s_name, '#', 2) as LastName
     , case when s_suppkey = 0 then 'Manager' else 'Agent' end as Title
     , case when s_suppkey = 0 then null else cast(s_suppkey % 3 as int) end as ReportsTo
     , date '1970-01-01' + cast(s_suppkey % 3650 as int) as BirthDate
     , date '2010-01-01' + cast(s_suppkey % 365 as int) as HireDate
     , n_name as City, r_name as Country
     , concat('s', cast(s_suppkey as string), '@Example.COM') as Email
  from supplier join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey""",
    "role_playlist": """
select distinct r_regionkey as PlaylistId, r_name as Name
  from lineitem join region on l_suppkey % 5 = r_regionkey""",
    "role_playlisttrack": """
select distinct cast(l_suppkey % 5 as int) as PlaylistId, cast(l_partkey as int) as TrackId
  from lineitem""",
    "all_customer": """
select cast(c_custkey as int) as CustomerId, split_part(c_name, '#', 1) as FirstName
     , split_part(c_name, '#', 2) as LastName
     , case when c_custkey % 7 = 0 then null else c_mktsegment end as Company
     , concat('No ', cast(c_custkey % 97 as string)) as Address, n_name as City
     , case when c_custkey % 5 = 0 then null else n_name end as State, r_name as Country
     , cast(10000 + c_custkey % 10000 as string) as PostalCode
     , concat('P', cast(c_custkey as string)) as Phone
     , case when c_custkey % 3 = 0 then concat('F', cast(c_custkey as string)) end as Fax
     , case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 then '   '
            else concat('  C', cast(c_custkey as string), '@Example.COM ') end as Email
     , cast(c_custkey % 10 as int) as SupportRepId, c_acctbal as balance
  from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey""",
    "role_customer": """
select CustomerId, FirstName, LastName, Company, Address, City, State, Country, PostalCode
     , Phone, Fax, Email, SupportRepId from all_customer""",
    "role_customer_day1": """
select CustomerId, FirstName, LastName, Company, Address, City, State, Country, PostalCode
     , Phone, Fax, Email, SupportRepId from all_customer where balance >= -450""",
    "role_customer_day2": """
select CustomerId, FirstName, LastName
     , case when CustomerId % 10 = 1 then 'Updated Corp' else Company end as Company
     , Address, City
     , case when CustomerId % 10 = 3 then null when CustomerId % 15 = 5 then 'Filled'
            else State end as State
     , Country, PostalCode, Phone, Fax, Email, SupportRepId
  from all_customer where balance <= 9780""",
    "customer_copies": """
select * from role_customer union all select * from role_customer where Email is null""",
    "role_invoice": """
select o_orderkey as InvoiceId
     , case when o_orderkey % 101 = 0 then null else cast(o_custkey as int) end as CustomerId
     , o_orderdate as InvoiceDate, n_name as BillingCity, r_name as BillingCountry
     , cast(case when o_orderkey % 53 = 0 then -o_totalprice else o_totalprice end
            as decimal(12,2)) as Total
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "role_invoice_text": """
select InvoiceId
     , case when InvoiceId % 97 = 0 then concat('day ', InvoiceId)
            when InvoiceId % 89 = 0 then '2024-13-45 00:00:00'
            else strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') end as InvoiceDate
  from role_invoice""",
    "role_invoiceline": """
select ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey
         as InvoiceLineId
     , l_orderkey as InvoiceId, cast(l_partkey as int) as TrackId
     , case when (l_orderkey + l_partkey) % 41 = 0 then 0
            else cast(l_quantity as int) end as Quantity
     , cast(l_extendedprice as decimal(10,2)) as UnitPrice
  from lineitem""",
    "role_runlog": """
select event_type as table_name, ts as execution_time
     , case when event_id % 10 = 0 then 'FAILED' else 'SUCCESS' end as status
     , concat('/raw/', event_type, '/', cast(event_id as string)) as file_location
     , cast(user_id as bigint) as source_row_count
     , cast(case when event_id % 10 = 0 then 0 else user_id end as bigint)
         as target_row_count
  from events""",
    "implied_registry": """
select table_name, concat(table_name, '.csv') as file_name
     , case when arg_max(status, row(execution_time, file_location)) = 'SUCCESS'
            then 'Y' else 'N' end as active_flag
     , min(cast(execution_time as date)) as created_date
     , max(cast(execution_time as date)) as modified_date
  from role_runlog group by table_name""",
    "good_invoice": """
select * from role_invoice
 where InvoiceId is not null and CustomerId is not null and InvoiceDate is not null""",
    "good_line": """
select * from role_invoiceline
 where InvoiceLineId is not null and InvoiceId is not null and TrackId is not null
   and Quantity >= 1""",
    "silver_day1": """
select CustomerId as customer_id, trim(FirstName) as first_name, trim(LastName) as last_name
     , coalesce(trim(Company), 'Individual') as company, trim(Address) as address
     , trim(City) as city, trim(State) as state, trim(Country) as country
     , trim(PostalCode) as postal_code, trim(Phone) as phone
     , coalesce(trim(Fax), 'N/A') as fax, lower(trim(Email)) as email
     , SupportRepId as support_rep_id
  from role_customer_day1 where CustomerId is not null""",
    "silver_day2": """
select CustomerId as customer_id, trim(FirstName) as first_name, trim(LastName) as last_name
     , coalesce(trim(Company), 'Individual') as company, trim(Address) as address
     , trim(City) as city, trim(State) as state, trim(Country) as country
     , trim(PostalCode) as postal_code, trim(Phone) as phone
     , coalesce(trim(Fax), 'N/A') as fax, lower(trim(Email)) as email
     , SupportRepId as support_rep_id
  from role_customer_day2 where CustomerId is not null""",
    "versions_day1": """
select row_number() over (order by customer_id) as customer_key, *
     , date '2024-01-15' as effective_start_date, cast(null as date) as effective_end_date
     , true as is_current
  from silver_day1""",
    "silver_all": """
select CustomerId as customer_id, trim(FirstName) as first_name, trim(LastName) as last_name
     , coalesce(trim(Company), 'Individual') as company, trim(Address) as address
     , trim(City) as city, trim(State) as state, trim(Country) as country
     , trim(PostalCode) as postal_code, trim(Phone) as phone
     , coalesce(trim(Fax), 'N/A') as fax, lower(trim(Email)) as email
     , SupportRepId as support_rep_id
  from role_customer where CustomerId is not null""",
    "versions_all": """
select row_number() over (order by customer_id) as customer_key, *
     , date '2024-01-15' as effective_start_date, cast(null as date) as effective_end_date
     , true as is_current
  from silver_all""",
    "changed_day2": """
select n.* from silver_day2 n join versions_day1 o on n.customer_id = o.customer_id
 where o.is_current and (n.first_name, n.last_name, n.company, n.address, n.city, n.state
       , n.country, n.postal_code, n.phone, n.fax, n.email, n.support_rep_id)
   is distinct from (o.first_name, o.last_name, o.company, o.address, o.city, o.state
       , o.country, o.postal_code, o.phone, o.fax, o.email, o.support_rep_id)""",
    "new_day2": """
select * from silver_day2 where customer_id not in (select customer_id from versions_day1)""",
    "expired_day2": """
select * replace (date '2024-02-15' as effective_end_date, false as is_current)
  from versions_day1 where customer_id in (select customer_id from changed_day2)""",
    "opened_changed": """
select (select max(customer_key) from versions_day1)
         + row_number() over (order by customer_id) as customer_key, *
     , date '2024-02-15' as effective_start_date, cast(null as date) as effective_end_date
     , true as is_current
  from changed_day2""",
    "opened_new": """
select (select max(customer_key) from versions_day1) + (select count(*) from changed_day2)
         + row_number() over (order by customer_id) as customer_key, *
     , date '2024-02-15' as effective_start_date, cast(null as date) as effective_end_date
     , true as is_current
  from new_day2""",
    "versions_day2": """
select * from versions_day1 where customer_id not in (select customer_id from changed_day2)
union all select * from expired_day2
union all select * from opened_changed
union all select * from opened_new""",
    "current_day2": """
select * from versions_day2 where is_current""",
    "changed_day3": """
select n.* from silver_all n join current_day2 o on n.customer_id = o.customer_id
 where (n.first_name, n.last_name, n.company, n.address, n.city, n.state
       , n.country, n.postal_code, n.phone, n.fax, n.email, n.support_rep_id)
   is distinct from (o.first_name, o.last_name, o.company, o.address, o.city, o.state
       , o.country, o.postal_code, o.phone, o.fax, o.email, o.support_rep_id)""",
    "new_day3": """
select * from silver_all where customer_id not in (select customer_id from versions_day2)""",
    "opened_day3": """
select (select max(customer_key) from versions_day2)
         + row_number() over (order by is_new, customer_id) as customer_key, * exclude (is_new)
     , date '2024-03-15' as effective_start_date, cast(null as date) as effective_end_date
     , true as is_current
  from (select *, 0 as is_new from changed_day3 union all select *, 1 from new_day3) n""",
    "versions_day3": """
select * from versions_day2
 where not is_current or customer_id not in (select customer_id from changed_day3)
union all
select * replace (date '2024-03-15' as effective_end_date, false as is_current)
  from current_day2 where customer_id in (select customer_id from changed_day3)
union all select * from opened_day3""",
    "years_3": """
select * replace (
         case effective_start_date when date '2024-01-15' then date '1996-02-01'
           when date '2024-02-15' then date '1998-03-01' else date '2000-04-01' end
         as effective_start_date
       , case effective_end_date when date '2024-02-15' then date '1998-03-01'
           when date '2024-03-15' then date '2000-04-01' end as effective_end_date)
  from versions_day3""",
    "planted": """
select customer_id, effective_start_date as s
     , case when customer_id % 10 = 1 then effective_end_date + 20
            when customer_id % 10 = 3 then effective_end_date - 20
            when customer_id % 15 = 5 then effective_start_date - 1
            else effective_end_date end as e
     , case when customer_id % 37 = 0 then not is_current else is_current end as c
  from years_3""",
    "faulty": """
select * from planted union all select * from planted where customer_id % 29 = 0 and c""",
    "boundary": """
select distinct customer_id, s as d from faulty where e is null or s <= e
union
select customer_id, e from faulty where s <= e""",
    "stretch": """
select b.customer_id, d, lead(d) over (partition by b.customer_id order by d) as next_d
     , (select count(*) from faulty f where f.customer_id = b.customer_id
           and (f.e is null or f.s <= f.e) and f.s <= d and (f.e is null or d < f.e)) as n
     , (select count(*) from faulty f where f.customer_id = b.customer_id
           and (f.e is null or f.s <= f.e) and f.s <= d) as begun
  from boundary b""",
    "gold_track_first": """
select row_number() over (order by TrackId) as track_key, TrackId as track_id
  from role_track where TrackId is not null and Name is not null and Composer is not null""",
    "gold_artist": """
select row_number() over (order by ArtistId) as artist_key, ArtistId as artist_id
     , trim(Name) as artist_name from role_artist""",
    "gold_genre": """
select row_number() over (order by GenreId) as genre_key, GenreId as genre_id
     , Name as genre_name from role_genre""",
    "gold_mediatype": """
select row_number() over (order by MediaTypeId) as media_type_key
     , MediaTypeId as media_type_id, Name as media_type_name from role_mediatype""",
    "gold_album": """
select row_number() over (order by AlbumId) as album_key, AlbumId as album_id
     , Title as album_title, ArtistId as artist_id from role_album""",
    "gold_track": """
select row_number() over (order by TrackId) as track_key, TrackId as track_id
     , Name as track_name, AlbumId as album_id, MediaTypeId as media_type_id
     , GenreId as genre_id, Composer as composer, Milliseconds as duration_ms
     , Bytes as file_size_bytes, UnitPrice as unit_price
  from role_track where TrackId is not null and Name is not null""",
    "gold_employee": """
select row_number() over (order by EmployeeId) as employee_key, EmployeeId as employee_id
     , concat_ws(' ', FirstName, LastName) as employee_name, Title as title
     , ReportsTo as reports_to_employee_id, cast(BirthDate as timestamp) as birth_date
     , cast(HireDate as timestamp) as hire_date, City as city, Country as country
     , Email as email from role_employee""",
    "gold_playlist": """
select row_number() over (order by PlaylistId) as playlist_key, PlaylistId as playlist_id
     , Name as playlist_name from role_playlist""",
    "gold_date": """
select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date
     , cast(year(full_date) as int) as year, cast(quarter(full_date) as int) as quarter
     , cast(month(full_date) as int) as month, strftime(full_date, '%B') as month_name
     , cast(day(full_date) as int) as day_of_month
     , cast(dayofweek(full_date) + 1 as int) as day_of_week
     , strftime(full_date, '%A') as day_name
     , dayofweek(full_date) in (0, 6) as is_weekend
  from (select distinct cast(InvoiceDate as date) as full_date from good_invoice) d""",
    "gold_fact": """
select il.InvoiceLineId as invoice_line_id, inv.InvoiceId as invoice_id, dc.customer_key
     , dt.track_key, dd.date_key, de.employee_key as support_rep_key
     , il.Quantity as quantity, il.UnitPrice as unit_price
     , cast(il.Quantity * il.UnitPrice as decimal(21,2)) as line_total
     , inv.BillingCountry as billing_country, inv.BillingCity as billing_city
  from good_line il join good_invoice inv on il.InvoiceId = inv.InvoiceId
  left join current_day2 dc on inv.CustomerId = dc.customer_id
  left join gold_track dt on il.TrackId = dt.track_id
  left join gold_date dd on cast(inv.InvoiceDate as date) = dd.full_date
  left join gold_employee de on dc.support_rep_id = de.employee_id""",
    "fact_totals": """
select customer_key, count(distinct invoice_id) as total_invoices
     , cast(sum(quantity) as bigint) as total_quantity
     , cast(sum(line_total) as decimal(31,2)) as total_revenue
     , cast(sum(cast(line_total * 100 as hugeint)) as hugeint) as cents, count(*) as lines
     , max(date_key) as last_purchase_date_key
  from gold_fact group by customer_key""",
    "gold_fact_by_customer": """
select t.customer_key, total_invoices, total_quantity, total_revenue
     , cast(cast((cents * 20000 + lines) // (2 * lines) as decimal(30,0))
            * cast(0.000001 as decimal(7,6)) as decimal(25,6)) as avg_line_total
     , last_purchase_date_key, customer_id, first_name, last_name, country, email
  from fact_totals t left join current_day2 c on t.customer_key = c.customer_key""",
}

_CUSTOMER = (
    "CustomerId FirstName LastName Company Address City State Country PostalCode Phone Fax "
    "Email SupportRepId"
).split()


def _union(parts) -> str:
    return "\nunion all\n".join(parts)


def _null_counts(view: str) -> str:
    return _union(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as null_count from {view}"
        for c in _CUSTOMER
    )


def _rule(table: str, rule: str, level: str, failed: str) -> str:
    return (
        f"select '{table}' as table_name, '{rule}' as rule, '{level}' as level"
        f", count(*) filter ({failed}) as failed_records from role_{table}"
    )


def _required(table: str, columns: str) -> list[str]:
    return [_rule(table, f"{c}:not_null", "error", f"{c} is null") for c in columns.split()]


def _summary(table: str, failed: str) -> str:
    return (
        f"select '{table}' as table_name, timestamp '2024-01-15 06:30:00' as run_timestamp"
        f", count(*) as total_records, count(*) filter (not ({failed})) as passed_records"
        f", count(*) filter ({failed}) as failed_records, date '2024-01-15' as created_date"
        f" from role_{table}"
    )


def _violations(table: str, view: str, check: str, tests: dict[str, str]) -> list[str]:
    return [
        f"select '{table}' as table_name, '{c}' as column_name, '{check}' as check"
        f", count(*) filter ({test}) as violations from {view}"
        for c, test in tests.items()
    ]


def _nulls(table: str, view: str, columns: str) -> list[str]:
    return _violations(table, view, "not_null", {c: f"{c} is null" for c in columns.split()})


def _lengths(table: str, view: str, columns: str) -> list[str]:
    pairs = [c.split(":") for c in columns.split()]
    return _violations(table, view, "max_length", {c: f"length({c}) > {n}" for c, n in pairs})


def _repeated(table: str, view: str, key: str) -> str:
    return (
        f"select '{table}' as table_name, cast({key} as bigint) as key, count(*) as rows"
        f" from {view} group by {key} having count(*) > 1"
    )


def _orphans(table: str, view: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name"
        f", cast({column} as bigint) as missing_key, count(*) as rows from {view}"
        f" where {column} is not null"
        f" and not exists (select 1 from {parent} p where p.{parent_column} = {view}.{column})"
        f" group by {column}"
    )


_BAD_INVOICE = "InvoiceId is null or CustomerId is null or InvoiceDate is null"
_BAD_LINE = (
    "InvoiceLineId is null or InvoiceId is null or TrackId is null or Quantity is null"
    " or Quantity < 1"
)
_BLANK = "Email is null or trim(Email) = ''"

QUERIES = {
    "scan_snapshot": "select InvoiceLineId, InvoiceId, Quantity, UnitPrice from role_invoiceline",
    "snapshot_fingerprint": """
select 'invoice' as table_name, 'as written' as copy, count(*) as rows, true as is_same
     , '' as columns from role_invoice
union all
select 'invoice', 'totals moved', count(*), count(*) filter (a.Total <> b.Total) = 0, ''
  from role_invoice a join role_invoice b on a.InvoiceId = xor(b.InvoiceId, 1)
union all
select 'customer', 'as written', count(*), true, '' from role_customer
union all
select 'customer', 'blank fax', count(*), count(*) filter (Fax is null) = 0
     , case when count(*) filter (Fax is null) = 0 then '' else 'Fax' end from role_customer
union all
select 'customer', 'places changed', count(*), false, 'City,Country' from role_customer""",
    "snapshot_diff": """
select coalesce(a.CustomerId, b.CustomerId) as CustomerId
     , case when a.CustomerId is null then 'added' when b.CustomerId is null then 'removed'
            when a is not distinct from b then 'unchanged' else 'changed' end as change
     , cast(a.CustomerId is not null as bigint) as rows_before
     , cast(b.CustomerId is not null as bigint) as rows_after
  from role_customer_day1 a full join role_customer_day2 b on a.CustomerId = b.CustomerId""",
    "row_count_reconcile": """
select table_name, count(*) as runs, cast(sum(source_row_count) as bigint) as source_rows
     , cast(sum(target_row_count) as bigint) as target_rows
     , count(*) filter (source_row_count <> target_row_count) as mismatched_runs
  from role_runlog group by table_name""",
    "insert_if_absent": """
select * from implied_registry
union all
select table_name, file_name, 'Y', date '2024-01-15', date '2024-01-15'
  from (values ('Album', 'album.csv'), ('Artist', 'artist.csv'), ('Customer', 'customer.csv')
             , ('Employee', 'employee.csv'), ('Genre', 'genre.csv')
             , ('Invoice', 'invoice.csv'), ('InvoiceLine', 'invoiceline.csv')
             , ('MediaType', 'mediatype.csv'), ('Playlist', 'playlist.csv')
             , ('PlaylistTrack', 'playlisttrack.csv'), ('Track', 'track.csv')
       ) s(table_name, file_name)
 where table_name not in (select table_name from implied_registry)""",
    "active_entries": """
select table_name, file_name from implied_registry where active_flag = 'Y'""",
    "latest_success": """
select table_name, file_location
  from (select *, row_number() over (partition by table_name
                    order by execution_time desc, file_location desc) as place
          from role_runlog where status = 'SUCCESS') r
 where place = 1""",
    "profile_rows": "select count(*) as total_rows from customer_copies",
    "profile_nulls": _null_counts("customer_copies"),
    "profile_null_columns": f"""
select * from ({_null_counts("customer_copies")}) n where null_count > 0""",
    "profile_duplicates": """
select (select count(*) from customer_copies)
         - (select count(*) from (select distinct * from customer_copies) d)
         as duplicate_rows""",
    "profile_schema": """
select cast(position as int) as position, column_name, data_type
     , (select count(*) from role_invoiceline) as total_rows
  from (values (1, 'InvoiceLineId', 'bigint'), (2, 'InvoiceId', 'bigint')
             , (3, 'TrackId', 'int'), (4, 'Quantity', 'int')
             , (5, 'UnitPrice', 'decimal(10,2)')) s(position, column_name, data_type)""",
    "dq_not_null": "select * from role_invoice where CustomerId is null",
    "dq_not_empty": f"select * from role_customer where {_BLANK}",
    "dq_min_value": "select * from role_invoiceline where Quantity is null or Quantity < 1",
    "dq_warn_only": "select *, true as passed from role_customer",
    "dq_tag_errors": """
select *, case when Quantity < 1 then '["Quantity:min_value"]' else '[]' end as _dq_errors
  from role_invoiceline""",
    "dq_valid": "select * from good_line",
    "dq_quarantine": """
select *, '["CustomerId:not_null"]' as _dq_errors from role_invoice
 where CustomerId is null""",
    "dq_no_rules": "select *, '[]' as _dq_errors from role_track",
    "quarantine_rows": """
select 'invoice' as table_name, timestamp '2024-01-15 06:30:00' as run_timestamp
     , '["CustomerId:not_null"]' as _error_details
     , concat('{"InvoiceId":', InvoiceId, ',"InvoiceDate":"'
            , strftime(InvoiceDate, '%Y-%m-%dT%H:%M:%S.000')
            , '","BillingCity":"', BillingCity, '","BillingCountry":"', BillingCountry
            , '","Total":', Total, '}') as _row_data
  from role_invoice where CustomerId is null
union all
select 'invoiceline', timestamp '2024-01-15 06:30:00', '["Quantity:min_value"]'
     , concat('{"InvoiceLineId":', InvoiceLineId, ',"InvoiceId":', InvoiceId, ',"TrackId":'
            , TrackId, ',"Quantity":', Quantity, ',"UnitPrice":', UnitPrice, '}')
  from role_invoiceline where Quantity < 1""",
    "dq_rule_counts": _union(
        _required("invoice", "InvoiceId CustomerId InvoiceDate")
        + [
            _rule("invoice", "Total:not_null", "warn", "Total is null"),
            _rule("invoice", "Total:min_value", "warn", "Total is null or Total < 0"),
        ]
        + _required("invoiceline", "InvoiceLineId InvoiceId TrackId Quantity")
        + [
            _rule(
                "invoiceline",
                "Quantity:min_value",
                "error",
                "Quantity is null or Quantity < 1",
            )
        ]
        + _required("customer", "CustomerId")
        + [_rule("customer", "Email:not_null_and_not_empty", "warn", _BLANK)]
        + _required("track", "TrackId Name")
        + _required("album", "AlbumId Title")
        + _required("artist", "ArtistId")
        + _required("genre", "GenreId")
        + _required("mediatype", "MediaTypeId")
        + _required("employee", "EmployeeId")
        + _required("playlist", "PlaylistId")
        + _required("playlisttrack", "PlaylistId TrackId")
    ),
    "dq_run_summary": _union(
        [
            _summary("invoice", _BAD_INVOICE),
            _summary("invoiceline", _BAD_LINE),
            _summary("customer", "CustomerId is null"),
            _summary("track", "TrackId is null or Name is null"),
            _summary("album", "AlbumId is null or Title is null"),
            _summary("artist", "ArtistId is null"),
            _summary("genre", "GenreId is null"),
            _summary("mediatype", "MediaTypeId is null"),
            _summary("employee", "EmployeeId is null"),
            _summary("playlist", "PlaylistId is null"),
            _summary("playlisttrack", "PlaylistId is null or TrackId is null"),
        ]
    ),
    "clean_trim": "select * replace (trim(Email) as Email) from role_customer",
    "clean_lower": "select * replace (lower(Email) as Email) from role_customer",
    "clean_fillna": """
select * replace (coalesce(Company, 'Individual') as Company, coalesce(Fax, 'N/A') as Fax)
  from role_customer""",
    "clean_timestamp": """
select EmployeeId, cast(BirthDate as timestamp) as BirthDate
     , cast(HireDate as timestamp) as HireDate from role_employee""",
    "clean_timestamp_text": """
select InvoiceId, try_cast(InvoiceDate as timestamp) as InvoiceDate
     , case when InvoiceDate is not null and try_cast(InvoiceDate as timestamp) is null
            then '["InvoiceDate:is_timestamp"]' else '[]' end as _dq_errors
  from role_invoice_text""",
    "clean_timestamp_strict": """
select InvoiceId, cast(try_cast(InvoiceDate as timestamp) as timestamp) as InvoiceDate
  from role_invoice_text
 where InvoiceDate is null or try_cast(InvoiceDate as timestamp) is not null""",
    "silver_customer": """
select * replace (lower(trim(Email)) as Email, coalesce(Company, 'Individual') as Company
     , coalesce(Fax, 'N/A') as Fax) from role_customer where CustomerId is not null""",
    "dim_artist": "select * from gold_artist",
    "dim_genre": "select * from gold_genre",
    "dim_mediatype": "select * from gold_mediatype",
    "dim_album": "select * from gold_album",
    "dim_track": "select * from gold_track",
    "dim_track_second_run": """
select t.* replace (coalesce(f.track_key, (select max(track_key) from gold_track_first)
         + row_number() over (partition by f.track_key is null order by t.track_id))
         as track_key)
  from gold_track t left join gold_track_first f on t.track_id = f.track_id""",
    "dim_employee": "select * from gold_employee",
    "dim_playlist": "select * from gold_playlist",
    "dim_date": "select * from gold_date",
    "scd2_initial": "select * from versions_all",
    "scd2_current": "select * from current_day2",
    "scd2_changed": "select customer_id from changed_day2",
    "scd2_changed_nullunsafe": """
select distinct n.customer_id
  from silver_day2 n join versions_day1 o on n.customer_id = o.customer_id
 where n.first_name <> o.first_name or n.last_name <> o.last_name or n.company <> o.company
    or n.address <> o.address or n.city <> o.city or n.state <> o.state
    or n.country <> o.country or n.postal_code <> o.postal_code or n.phone <> o.phone
    or n.fax <> o.fax or n.email <> o.email or n.support_rep_id <> o.support_rep_id""",
    "scd2_expired": "select * from expired_day2",
    "scd2_new_versions": "select * from opened_changed",
    "scd2_inserts": "select * from opened_new",
    "scd2_merge": "select * from versions_day2",
    "scd2_merge_again": "select * from versions_day3",
    "scd2_merge_by_diff": "select * from versions_day3",
    "scd2_missing_kept": """
select * from current_day2
 where customer_id not in (select customer_id from silver_day2)""",
    "scd2_as_of": """
select * from versions_day2 where effective_start_date <= date '2024-02-01'
   and (effective_end_date is null or effective_end_date > date '2024-02-01')""",
    "scd2_history_shape": """
select customer_id, case when n > 1 then 'overlap' else 'gap' end as fault, d as from_date
     , next_d as to_date, n as versions
  from stretch where n > 1 or (n = 0 and next_d is not null)
union all
select customer_id, 'several_current', null, null, count(*) from faulty where c
 group by customer_id having count(*) > 1
union all
select customer_id, 'reversed', s, e, count(*) from faulty where e < s group by customer_id, s, e
union all
select customer_id, 'flag', s, e, count(*) from faulty where c <> (e is null)
 group by customer_id, s, e""",
    "join_inner": """
select InvoiceLineId, l.InvoiceId, CustomerId, Quantity, UnitPrice
  from role_invoiceline l join role_invoice i on l.InvoiceId = i.InvoiceId""",
    "join_left_scd2": """
select InvoiceId, CustomerId, customer_key, support_rep_id
  from good_invoice left join current_day2 on CustomerId = customer_id""",
    "join_on_expression": """
select InvoiceId, date_key
  from good_invoice left join gold_date on cast(InvoiceDate as date) = full_date""",
    "semi_join_changed": "select * from changed_day2",
    "anti_join_new": "select * from new_day2",
    "fact_sales": "select * from gold_fact",
    "fact_sales_as_of": """
select il.InvoiceLineId as invoice_line_id, inv.InvoiceId as invoice_id, dc.customer_key
     , dt.track_key, dd.date_key, de.employee_key as support_rep_key
     , il.Quantity as quantity, il.UnitPrice as unit_price
     , cast(il.Quantity * il.UnitPrice as decimal(21,2)) as line_total
     , inv.BillingCountry as billing_country, inv.BillingCity as billing_city
  from good_line il join good_invoice inv on il.InvoiceId = inv.InvoiceId
  left join years_3 dc on inv.CustomerId = dc.customer_id
    and dc.effective_start_date <= cast(inv.InvoiceDate as date)
    and (dc.effective_end_date is null or cast(inv.InvoiceDate as date) < dc.effective_end_date)
  left join gold_track dt on il.TrackId = dt.track_id
  left join gold_date dd on cast(inv.InvoiceDate as date) = dd.full_date
  left join gold_employee de on dc.support_rep_id = de.employee_id""",
    "fact_sales_customer_agg": "select * from gold_fact_by_customer",
    "fact_sales_customer_agg_refresh": "select * from gold_fact_by_customer",
    "join_heavy_keys": """
select l.TrackId, t.AlbumId, count(*) as lines, cast(sum(Quantity) as bigint) as pieces
  from (select case when Quantity >= 40 then 0 else TrackId end as TrackId, Quantity
          from role_invoiceline) l
  left join role_track t on l.TrackId = t.TrackId
 group by l.TrackId, t.AlbumId""",
    "surrogate_key": """
select *, row_number() over (order by AlbumId) as album_key from role_album""",
    "row_number_key": """
select row_number() over (order by CustomerId) as customer_key, CustomerId as customer_id
     , lower(trim(Email)) as email
  from role_customer""",
    "key_continuation": """
select customer_id, phone, (select max(customer_key) from versions_day1)
         + row_number() over (order by customer_id) as customer_key
  from silver_all""",
    "dense_key": """
select InvoiceLineId, TrackId, Quantity
     , row_number() over (order by TrackId, InvoiceLineId) as line_key
  from role_invoiceline""",
    "scalar_dates": """
select l_orderkey, l_linenumber, cast(l_shipdate as date) as full_date
     , cast(strftime(l_shipdate, '%Y%m%d') as int) as date_key
     , cast(year(l_shipdate) as int) as year, cast(quarter(l_shipdate) as int) as quarter
     , cast(month(l_shipdate) as int) as month, strftime(l_shipdate, '%B') as month_name
     , cast(day(l_shipdate) as int) as day_of_month
     , cast(dayofweek(l_shipdate) + 1 as int) as day_of_week
     , strftime(l_shipdate, '%A') as day_name
     , dayofweek(l_shipdate) in (0, 6) as is_weekend
  from lineitem""",
    "scalar_strings": """
select CustomerId, trim(Email) as trimmed, lower(Email) as lowered
     , concat_ws(' ', FirstName, Company, State) as joined from role_customer""",
    "scalar_json": """
select CustomerId
     , concat('[', concat_ws(',', '"' || Company || '"', '"' || State || '"'
            , '"' || Fax || '"'), ']') as parts
     , concat('{"CustomerId":', CustomerId, ',"Address":"', Address, '","SupportRepId":'
            , SupportRepId, '}') as record
  from role_customer""",
    "scalar_conditional": """
select InvoiceId, CustomerId is null as is_anonymous
     , coalesce(CustomerId, 0) as customer_or_zero
     , case when Total < 0 then 'credit' when Total = 0 then 'empty' else 'sale' end as kind
     , cast(Total <> 0 as int) as counts
     , BillingCountry in ('ASIA', 'EUROPE') as is_overseas
     , cast(InvoiceDate as date) as invoice_day, cast(null as date) as closed_on
  from role_invoice""",
    "conform_fact": """
select * replace (cast(line_total as decimal(10,2)) as line_total) from gold_fact""",
    "contract_not_null": _union(
        _nulls(
            "dim_date",
            "gold_date",
            "date_key full_date year quarter month month_name day_of_month day_of_week day_name"
            " is_weekend",
        )
        + _nulls("dim_artist", "gold_artist", "artist_key artist_id")
        + _nulls("dim_album", "gold_album", "album_key album_id album_title artist_id")
        + _nulls("dim_genre", "gold_genre", "genre_key genre_id")
        + _nulls("dim_mediatype", "gold_mediatype", "media_type_key media_type_id")
        + _nulls(
            "dim_track", "gold_track", "track_key track_id track_name media_type_id unit_price"
        )
        + _nulls(
            "dim_customer",
            "versions_day2",
            "customer_key customer_id first_name last_name email effective_start_date"
            " is_current",
        )
        + _nulls("dim_employee", "gold_employee", "employee_key employee_id employee_name")
        + _nulls("dim_playlist", "gold_playlist", "playlist_key playlist_id")
        + _nulls(
            "fact_sales",
            "gold_fact",
            "invoice_line_id invoice_id customer_key track_key date_key quantity unit_price"
            " line_total",
        )
        + _nulls(
            "fact_sales_customer_agg",
            "gold_fact_by_customer",
            "customer_key total_invoices total_quantity total_revenue",
        )
    ),
    "contract_length": _union(
        _lengths("dim_date", "gold_date", "month_name:20 day_name:20")
        + _lengths("dim_artist", "gold_artist", "artist_name:200")
        + _lengths("dim_album", "gold_album", "album_title:300")
        + _lengths("dim_genre", "gold_genre", "genre_name:120")
        + _lengths("dim_mediatype", "gold_mediatype", "media_type_name:120")
        + _lengths("dim_track", "gold_track", "track_name:300 composer:300")
        + _lengths(
            "dim_customer",
            "versions_day2",
            "first_name:100 last_name:100 company:200 address:200 city:100 state:100"
            " country:100 postal_code:20 phone:50 fax:50 email:200",
        )
        + _lengths(
            "dim_employee",
            "gold_employee",
            "employee_name:200 title:100 city:100 country:100 email:200",
        )
        + _lengths("dim_playlist", "gold_playlist", "playlist_name:200")
        + _lengths("fact_sales", "gold_fact", "billing_country:100 billing_city:100")
        + _lengths(
            "fact_sales_customer_agg",
            "gold_fact_by_customer",
            "first_name:100 last_name:100 country:100 email:200",
        )
    ),
    "contract_pk": _union(
        [
            _repeated("dim_date", "gold_date", "date_key"),
            _repeated("dim_artist", "gold_artist", "artist_key"),
            _repeated("dim_album", "gold_album", "album_key"),
            _repeated("dim_genre", "gold_genre", "genre_key"),
            _repeated("dim_mediatype", "gold_mediatype", "media_type_key"),
            _repeated("dim_track", "gold_track", "track_key"),
            _repeated("dim_customer", "versions_day2", "customer_key"),
            _repeated("dim_employee", "gold_employee", "employee_key"),
            _repeated("dim_playlist", "gold_playlist", "playlist_key"),
            _repeated("fact_sales", "gold_fact", "invoice_line_id"),
            _repeated("fact_sales_customer_agg", "gold_fact_by_customer", "customer_key"),
            _repeated("invoiceline", "role_invoiceline", "TrackId"),
        ]
    ),
    "contract_fk": _union(
        [
            _orphans("dim_album", "gold_album", "artist_id", "gold_artist", "artist_id"),
            _orphans("dim_track", "gold_track", "album_id", "gold_album", "album_id"),
            _orphans(
                "dim_track", "gold_track", "media_type_id", "gold_mediatype", "media_type_id"
            ),
            _orphans("dim_track", "gold_track", "genre_id", "gold_genre", "genre_id"),
            _orphans(
                "fact_sales", "gold_fact", "customer_key", "versions_day2", "customer_key"
            ),
            _orphans("fact_sales", "gold_fact", "track_key", "gold_track", "track_key"),
            _orphans("fact_sales", "gold_fact", "date_key", "gold_date", "date_key"),
            _orphans(
                "fact_sales", "gold_fact", "support_rep_key", "gold_employee", "employee_key"
            ),
            _orphans(
                "fact_sales_customer_agg",
                "gold_fact_by_customer",
                "customer_key",
                "versions_day2",
                "customer_key",
            ),
            _orphans(
                "invoice", "role_invoice", "CustomerId", "role_customer_day2", "CustomerId"
            ),
        ]
    ),
    "changes_insert": """
select * from role_customer_day1
union all
select cast((select max(CustomerId) from role_customer_day1)
         + row_number() over (order by Phone) as int)
     , FirstName, LastName, Company, Address, City, State, Country, PostalCode, Phone
     , cast(null as varchar), Email, SupportRepId
  from role_customer_day2
 where CustomerId not in (select CustomerId from role_customer_day1)""",
    "changes_patch": """
select t.* replace (
         case when c.Company = 'Updated Corp' then c.Company else t.Company end as Company
       , case when c.CustomerId is not null and (c.State is null or c.State = 'Filled')
              then c.State else t.State end as State)
  from role_customer t left join role_customer_day2 c on t.CustomerId = c.CustomerId""",
    "changes_patch_in": """
select * replace (
         cast(case when InvoiceLineId in (select InvoiceLineId from role_invoiceline
                                           where Quantity = 0)
                   then 2.99 else UnitPrice end as decimal(10,2)) as UnitPrice
       , case when InvoiceLineId in (select InvoiceLineId from role_invoiceline
                                      where Quantity = 0) then 2 else Quantity end as Quantity)
  from role_invoiceline""",
    "verify_dump": "select * from versions_day2",
    "verify_count": "select count(*) as rows from versions_day2",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    """The views a text reads, directly or through others, inner ones first."""
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found.append(name)
    return found


def statement(name: str) -> str:
    sql = QUERIES[name]
    views = _needed(sql, [])
    if not views:
        return sql
    return "with " + "\n, ".join(f"{v} as ({VIEWS[v]})" for v in views) + "\n" + sql


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
