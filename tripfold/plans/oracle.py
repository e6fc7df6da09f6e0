"""The registered queries as SQL for another engine, over the same tables."""

from __future__ import annotations

from textwrap import dedent

from tripfold.schemas import END_FIELDS, STAGING_FIELDS, START_FIELDS

SECONDS = "%Y-%m-%d %H:%M:%S"

TRIPS = f"""
starts as (
  select cast(o_orderkey as varchar) as trip_id,
         cast(o_custkey as varchar) as pickup_location_id,
         o_orderstatus as dropoff_location_id,
         cast(1 + o_orderkey % 2 as varchar) as vendor_id,
         o_orderdate as pickup_at,
         strftime(o_orderdate, '{SECONDS}') as pickup_datetime,
         strftime(o_orderdate + interval 1 hour, '{SECONDS}') as estimated_dropoff_datetime,
         cast(o_totalprice as double) as estimated_fare_amount
  from orders),
ends as (
  select cast(l_orderkey as varchar) as trip_id,
         strftime(l_shipdate, '{SECONDS}') as dropoff_datetime,
         cast(l_linenumber as double) as rate_code,
         cast(null as double) as passenger_count,
         l_quantity as trip_distance,
         cast(l_extendedprice as decimal(18,2)) as fare,
         l_extendedprice as fare_amount,
         cast(cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
              as decimal(18,2)) as double) as tip_amount,
         cast(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as double) as payment_type,
         cast(case l_linestatus when 'F' then 1 else 2 end as double) as trip_type,
         l_shipdate as moment, l_linenumber as line, l_partkey as part, l_suppkey as supp,
         l_extendedprice as price
  from lineitem),
last_end as (
  select * from ends
  qualify row_number() over (partition by trip_id
          order by moment desc, line desc, part desc, supp desc, price desc) = 1)
"""

# The log in order, with what is known of the trip at every event.
HISTORY = (
    TRIPS
    + """,
log as (
  select trip_id, 'start' as kind, pickup_at as moment, 0 as rank, 0 as line, 0 as part, 0 as supp,
         0.0::double as price, cast(null as double) as rate_code from starts
  union all
  select trip_id, 'end', moment, 1, line, part, supp, price, rate_code from ends),
numbered as (
  select *, row_number() over (order by trip_id, moment, rank, line, part, supp, price) as id from log),
history as (
  select *,
         last_value(case when kind = 'start' then id end ignore nulls) over w as start_id,
         last_value(case when kind = 'end' then id end ignore nulls) over w as end_id,
         count(*) filter (where kind = 'start') over w as n_start,
         count(*) filter (where kind = 'end') over w as n_end
  from numbered
  window w as (partition by trip_id order by id rows between unbounded preceding and current row)),
ended as (
  select n.id, e.*, lag(row(e.dropoff_datetime, e.rate_code, e.trip_distance, e.fare, e.tip_amount,
                            e.payment_type, e.trip_type))
                   over (partition by e.trip_id order by n.id) as before,
         row(e.dropoff_datetime, e.rate_code, e.trip_distance, e.fare, e.tip_amount,
             e.payment_type, e.trip_type) as now
  from numbered n join ends e
    on n.kind = 'end' and n.trip_id = e.trip_id and n.moment = e.moment and n.line = e.line
   and n.part = e.part and n.supp = e.supp and n.price = e.price)
"""
)

START_COLUMNS = ", ".join(f"s.{c}" for c in START_FIELDS)
END_COLUMNS = ", ".join(f"e.{c}" for c in END_FIELDS)

KPIS = """
select strftime(day, '%Y-%m-%d') as pickup_date,
       cast(sum(fare) as double) as total_fare,
       count(*) as count_trips,
       cast(sum(fare) as double) / nullif(count(fare), 0) as average_fare,
       cast(max(fare) as double) as max_fare,
       cast(min(fare) as double) as min_fare
from trips where day is not null group by day
"""

DAILY = f"with {TRIPS}, trips as (select cast(pickup_at as date) as day, fare from starts join last_end using (trip_id)) {KPIS}"

MODIFIED = """
modified as (
  select h.* from history h left join ended x on x.id = h.id
  where h.n_start + h.n_end > 1 and (h.kind = 'start' or x.before is null or x.now is distinct from x.before))
"""

USERS = f"""
log as (
  select cast(user_id as varchar) as trip_id, event_id, event_type,
         case when event_type = 'purchase' then 'end' else 'start' end as kind,
         ts as moment, cast(ts as varchar) as at_text,
         cast("value" as decimal(18,2)) as amount
  from events where event_type in ('signup', 'view', 'purchase')),
seen as (
  select *,
         last_value(case when kind = 'start' then event_id end ignore nulls) over w as start_id,
         last_value(case when kind = 'end' then event_id end ignore nulls) over w as end_id,
         count(*) filter (where kind = 'start') over w as n_start,
         count(*) filter (where kind = 'end') over w as n_end,
         row_number() over w as n
  from log
  window w as (partition by trip_id order by event_id rows between unbounded preceding and current row))
"""

USER_CURRENT = f"""
with {USERS}, last_event as (
  select trip_id, max(event_id) filter (where kind = 'start') as start_id,
         max(event_id) filter (where kind = 'end') as end_id from log group by trip_id),
trips as (
  select cast(s.moment as date) as day, e.amount as fare
  from last_event h join log s on s.event_id = h.start_id join log e on e.event_id = h.end_id) {KPIS}
"""

FIRST_OF_KIND = "h.n_start >= 1 and h.n_end >= 1 and (case h.kind when 'start' then h.n_start else h.n_end end) = 1"

REASON_OF_EVENT = """
case event_type when 'error' then 'bad_base64' when 'click' then 'bad_utf8'
                when 'view' then 'bad_json' when 'purchase' then 'not_object' end
"""

USER_STAGING = {
    "trip_id": "trip_id",
    "fare_amount": "case when kind = 'end' then cast(amount as varchar) end",
    "estimated_fare_amount": "case when kind = 'start' then cast(amount as varchar) end",
    "pickup_datetime": "case when kind = 'start' then at_text end",
    "vendor_id": "case when kind = 'start' then event_type end",
    "dropoff_datetime": "case when kind = 'end' then at_text end",
}

BODY_COLUMNS = {
    "trip_id": "s.trip_id",
    "fare_amount": "cast(e.fare as varchar)",
    "estimated_fare_amount": "cast(cast(s.estimated_fare_amount as decimal(18,2)) as varchar)",
    "rate_code": "cast(cast(e.rate_code as decimal(18,2)) as varchar)",
    "trip_distance": "cast(cast(e.trip_distance as decimal(18,2)) as varchar)",
    "payment_type": "cast(cast(e.payment_type as int) as varchar)",
    "trip_type": "cast(cast(e.trip_type as int) as varchar)",
    "tip_amount": "cast(cast(e.tip_amount as decimal(18,2)) as varchar)",
    "dropoff_datetime": "e.dropoff_datetime",
}

ORACLE = {
    "assemble_trips": f"""
        with {TRIPS}
        select coalesce(s.trip_id, e.trip_id) as trip_id, {START_COLUMNS}, {END_COLUMNS},
               cast(s.trip_id is not null as bigint) as has_start,
               cast(e.trip_id is not null as bigint) as has_end
        from starts s full outer join last_end e on s.trip_id = e.trip_id""",
    "completed_trips": f"""
        with {TRIPS}
        select s.trip_id, {START_COLUMNS}, {END_COLUMNS}
        from starts s join last_end e on s.trip_id = e.trip_id""",
    "open_trips": f"""
        with {TRIPS}
        select coalesce(s.trip_id, e.trip_id) as trip_id, s.pickup_datetime, e.dropoff_datetime
        from starts s full outer join last_end e on s.trip_id = e.trip_id
        where s.trip_id is null or e.trip_id is null""",
    "first_completion": f"""
        with {HISTORY}
        select h.trip_id, {START_COLUMNS}, {END_COLUMNS}
        from history h join starts s on s.trip_id = h.trip_id join ended e on e.id = h.end_id
        where h.start_id is not null and {FIRST_OF_KIND}""",
    "change_feed": f"""
        with {USERS}
        select h.trip_id, h.event_id as sequence, case when h.n = 1 then 'INSERT' else 'MODIFY' end as event_name,
               cast(null as varchar) as pickup_location_id, cast(null as varchar) as dropoff_location_id,
               s.event_type as vendor_id, s.at_text as pickup_datetime,
               cast(null as varchar) as estimated_dropoff_datetime,
               cast(s.amount as double) as estimated_fare_amount, e.at_text as dropoff_datetime,
               cast(null as double) as rate_code, cast(null as double) as passenger_count,
               cast(null as double) as trip_distance, cast(e.amount as double) as fare_amount,
               cast(null as double) as tip_amount, cast(null as double) as payment_type,
               cast(null as double) as trip_type
        from seen h left join log s on s.event_id = h.start_id left join log e on e.event_id = h.end_id""",
    "modified_trips": f"""
        with {HISTORY}, {MODIFIED}
        select h.trip_id, {START_COLUMNS}, {END_COLUMNS}
        from modified h left join starts s on s.trip_id = h.trip_id and h.start_id is not null
             left join ended e on e.id = h.end_id""",
    "kpi_daily": DAILY,
    "kpi_incremental": DAILY,
    "kpi_merge": DAILY,
    "kpi_first_completion": f"""
        with {HISTORY}, trips as (
          select cast(s.pickup_at as date) as day, e.fare
          from history h join starts s on s.trip_id = h.trip_id join ended e on e.id = h.end_id
          where h.start_id is not null and {FIRST_OF_KIND}) {KPIS}""",
    "kpi_change_feed_mode": f"""
        with {HISTORY}, {MODIFIED}, trips as (
          select cast(s.pickup_at as date) as day, e.fare
          from modified h join starts s on s.trip_id = h.trip_id and h.start_id is not null
               left join ended e on e.id = h.end_id) {KPIS}""",
    "kpi_null_fares": f"""
        with {TRIPS}, trips as (
          select cast(pickup_at as date) as day, case when line <> 7 then fare end as fare
          from starts join last_end using (trip_id)) {KPIS}""",
    "kpi_published": USER_CURRENT,
    "message_stream_kpi": USER_CURRENT,
    "stream_kpi": f"""
        with {USERS}, trips as (
          select cast(s.moment as date) as day, e.amount as fare
          from seen h join log s on s.event_id = h.start_id join log e on e.event_id = h.end_id
          where {FIRST_OF_KIND}) {KPIS}""",
    "stream_kpi_change_feed": f"""
        with {USERS}, trips as (
          select cast(s.moment as date) as day, e.amount as fare
          from seen h join log s on s.event_id = h.start_id left join log e on e.event_id = h.end_id
          where h.n > 1) {KPIS}""",
    "envelope_roundtrip": f"""
        with {TRIPS}
        select s.trip_id, 'start' as kind, {START_COLUMNS},
               {", ".join(f"cast(null as {'varchar' if c == 'dropoff_datetime' else 'double'}) as {c}" for c in END_FIELDS)}
        from starts s
        union all
        select e.trip_id, 'end',
               {", ".join(f"cast(null as {'double' if c == 'estimated_fare_amount' else 'varchar'}) as {c}" for c in START_FIELDS)},
               {END_COLUMNS}
        from ends e""",
    "decode_quarantine": f"""
        select 'ingest' as stage, {REASON_OF_EVENT} as reason, cast(event_id as varchar) as sequence
        from events where event_type <> 'signup'""",
    "quarantine_reasons": f"""
        select {REASON_OF_EVENT} as reason, count(*) as rows
        from events where event_type <> 'signup' group by 1""",
    "batch_counters": """
        select count(*) as records, count(*) filter (where event_type = 'signup') as success,
               count(*) filter (where event_type <> 'signup') as failed, 0::bigint as skipped, 0::bigint as warnings
        from events""",
    "route_events": """
        with routed as (
          select case when user_id = 0 then 'missing_trip_id' when event_type = 'view' then 'missing_datetimes'
                      when event_type = 'error' then 'bad_pickup_datetime' end as reason,
                 case when event_type = 'purchase' then 'end' else 'start' end as kind
          from events)
        select case when reason is null then kind end as kind, reason, count(*) as events
        from routed group by 1, 2""",
    "unwrap_image": f"""
        with {USERS}, records as (
          select *, case when kind = 'end' and amount < 10 then 'empty_image' end as reason
          from log where event_type <> 'signup')
        select event_id as sequence, reason,
               {", ".join(f"case when reason is null then {USER_STAGING.get(c, 'cast(null as varchar)')} end as {c}" for c in STAGING_FIELDS)}
        from records""",
    "staging_cast": f"""
        select cast(l_orderkey as varchar) as trip_id,
               case l_linenumber when 7 then 'abc' when 6 then 'NaN' when 5 then '' when 4 then null
                    else ' ' || cast(cast(l_extendedprice as decimal(18,2)) as varchar) || ' ' end as fare_amount,
               case when l_linenumber < 4 then l_extendedprice end as fare,
               case when l_returnflag <> 'R' then strftime(l_shipdate, '%Y-%m-%d') end as pickup_date,
               case when l_returnflag = 'R' then 'bad_pickup_datetime' end as reason,
               case when l_returnflag <> 'R' and l_linenumber > 4 then 'bad_fare' end as warning
        from lineitem""",
    "message_bodies": f"""
        with {TRIPS}
        select {", ".join(f"{BODY_COLUMNS.get(c, 's.' + c)} as {c}" for c in STAGING_FIELDS)}
        from starts s join last_end e on s.trip_id = e.trip_id""",
    "csv_scan": f"""
        with {TRIPS}
        select trip_id, 'start' as kind, pickup_datetime, estimated_fare_amount,
               cast(null as varchar) as dropoff_datetime, cast(null as double) as fare_amount,
               cast(null as double) as tip_amount, cast(null as double) as trip_type,
               cast(null as varchar) as reason, cast(null as varchar) as warning from starts
        union all
        select trip_id, 'end', null, null, case when rate_code <> 7 then dropoff_datetime end, fare_amount,
               case when rate_code <> 6 then tip_amount end, trip_type,
               case when rate_code = 7 then 'bad_dropoff_datetime' end,
               case when rate_code = 6 then 'bad_tip_amount' end from ends""",
    "field_warnings": f"""
        with rows as (
          select case when l_linenumber = 7 then 'bad_dropoff_datetime' end as reason,
                 case l_linenumber when 6 then 'bad_tip_amount,bad_payment_type' when 5 then 'rounded_tip_amount' end as warning,
                 case when l_linenumber <> 7 then strftime(l_shipdate, '{SECONDS}') || '.25' end as dropoff_datetime,
                 case l_linenumber when 6 then null when 5 then 12.35 else 1.5 end as tip,
                 case when l_linenumber <> 6 then 1 end as payment from lineitem)
        select reason, warning, dropoff_datetime, count(*) as events, cast(sum(tip) as double) as tips,
               cast(sum(payment) as bigint) as payments
        from rows group by all""",
    "repeated_sequences": f"""
        with {TRIPS}
        select trip_id, fare_amount, case when tip_amount > 100 then tip_amount end as tip_amount from ends
        qualify row_number() over (partition by trip_id order by fare_amount desc,
                case when tip_amount > 100 then tip_amount end desc nulls last) = 1""",
    "change_feed_coded": f"""
        with {USERS}, changes as (
          select trip_id, 10 * event_id as sequence from log
          union all select trip_id, 10 * event_id + 5 from log where event_id % 5 = 0)
        select trip_id, count(*) as changes, max(sequence) as last_sequence from changes group by trip_id""",
    "open_trips_stream": f"""
        with {USERS}, short as (
          select *, trip_id || '/' || cast(event_id % 50 as varchar) as trip from log),
        ends as (
          select trip, max(event_id) filter (where kind = 'start') as start_id,
                 max(event_id) filter (where kind = 'end') as end_id from short group by trip)
        select h.trip as trip_id, s.event_type as vendor_id, s.at_text as pickup_datetime,
               e.at_text as dropoff_datetime, cast(e.amount as double) as fare_amount
        from ends h left join short s on s.event_id = h.start_id left join short e on e.event_id = h.end_id
        where h.start_id is null or h.end_id is null""",
    "stream_counters": """
        with bounds as (select min(event_id) as low, max(event_id) as high from events),
        parts as (
          select least(3, cast(floor((event_id - low) * 4 / (high - low + 1)) as bigint)) as batch, event_type
          from events, bounds)
        select batch, count(*) as records, count(*) filter (where event_type = 'signup') as success,
               count(*) filter (where event_type <> 'signup') as failed, 0::bigint as skipped, 0::bigint as warnings
        from parts group by batch""",
    "hot_trip": f"""
        with {TRIPS}, hot as (
          select *, case when cast(trip_id as bigint) % 3 = 0 then 'hot' else trip_id end as trip from ends)
        select trip as trip_id, 1::bigint as inserts, fare_amount from hot
        qualify row_number() over (partition by trip
                order by moment desc, line desc, part desc, supp desc, price desc) = 1""",
    "envelope_batches": f"""
        with {USERS}, last_event as (
          select trip_id, max(event_id) filter (where kind = 'start') as start_id,
                 max(event_id) filter (where kind = 'end') as end_id from log group by trip_id)
        select h.trip_id, s.at_text as pickup_datetime, cast(e.amount as double) as fare_amount
        from last_event h left join log s on s.event_id = h.start_id left join log e on e.event_id = h.end_id""",
    "change_batches": f"""
        with {USERS}
        select count(*) as records, count(*) filter (where event_id % 5 <> 0) as success, 0::bigint as failed,
               count(*) filter (where event_id % 5 = 0) as skipped, cast(max(event_id) as varchar) as last_sequence
        from seen where n > 1""",
    "matched_sample": f"""
        with {TRIPS}, chosen as (
          select trip_id from starts semi join ends using (trip_id)
          order by md5(concat_ws('|', '42', trip_id)), trip_id limit 10)
        select trip_id, 'start' as kind, pickup_datetime, cast(null as varchar) as dropoff_datetime,
               cast(null as double) as fare_amount
        from starts semi join chosen using (trip_id)
        union all
        select trip_id, 'end', null, dropoff_datetime, fare_amount from ends semi join chosen using (trip_id)""",
    "interleave_keys": f"""
        with {USERS}
        select trip_id, kind, cast(event_id as varchar) as event,
               cast('0x' || substr(md5(concat_ws('|', '42', trip_id, kind, cast(event_id as varchar))), 1, 15)
                    as bigint) as sequence
        from log""",
    "interleave": f"""
        with {USERS}
        select trip_id, kind, cast(event_id as varchar) as event,
               row_number() over (order by substr(md5(concat_ws('|', '42', trip_id, kind, cast(event_id as varchar))), 1, 15),
                                  trip_id, kind, cast(event_id as varchar)) as sequence
        from log""",
}
ORACLE["kpi_batch_then_stream"] = ORACLE["stream_kpi"]
ORACLE["assemble_trips_table"] = ORACLE["assemble_trips"]
ORACLE["kpi_two_pipelines"] = ORACLE["stream_kpi"]
ORACLE["kpi_corrections_stream"] = USER_CURRENT
ORACLE = {name: dedent(sql).strip() for name, sql in ORACLE.items()}
