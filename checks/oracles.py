"""The SQL that checks each query, over the same tables."""

from __future__ import annotations

NOW = 1705276800

# Shared record views, written out into each statement that names them.
VIEWS = {
    "status": """select event_id seq, ts, user_id::varchar station_id,
        floor(value)::int num_bikes_available, event_type, value from events""",
    "info": """select s_suppkey::varchar station_id, s_name name,
        ((s_nationkey % 7) * 20)::int capacity from supplier""",
    "versions": """select event_id seq, user_id::varchar station_id,
        nullif(floor(value)::int, 0) capacity from events where event_type = 'signup'""",
    "ticks": """select event_type ticker, date_trunc('day', ts)::timestamp trade_date,
        avg(value) price from events group by 1, 2""",
    "tickers": "select distinct event_type t from events",
    "pairs": "select a.t t1, b.t t2 from tickers a join tickers b on a.t < b.t",
    "days": """select t1, t2, trade_date,
        max(case when ticker = t1 then price end) a, max(case when ticker = t2 then price end) b
        from ticks join pairs on ticker = t1 or ticker = t2 group by 1, 2, 3""",
    "day_windows": """select t1, t2, a, b, trade_date - to_days(k::int) window_start,
        trade_date - to_days(k::int) + interval 10 day window_end
        from days, range(10) r(k)""",
    "correlations": """select t1, t2, window_start, window_end,
        case when count(a) = 0 or count(b) = 0 then 0.0 else
          case when isnan(corr(a, b)) then null else corr(a, b) end end corr
        from day_windows group by 1, 2, 3, 4""",
    "updates": """select event_id seq, event_type route_id,
        lpad((user_id % 1000)::varchar, 3, '0') stop_id,
        case when event_id % 2 = 0 then 'N' else 'S' end direction,
        floor(epoch(ts))::bigint + floor(value * 60)::bigint arrival, event_type, value from events""",
    "arrivals": """select seq, route_id, stop_id, direction, arrival from updates
        where not (event_type = 'error' and value < 5) and value < 250""",
    "upcoming": f"select * from arrivals where arrival >= {NOW}",
    "all_upcoming": f"select * from updates where arrival >= {NOW}",
    "improvements": """select seq, route_id, stop_id, direction, arrival from (
        select *, min(arrival) over (partition by route_id, stop_id, direction order by seq
          rows between unbounded preceding and 1 preceding) best from all_upcoming)
        where best is null or arrival < best""",
    "stops": """select lpad((s_suppkey % 1000)::varchar, 3, '0') stop_id, min(s_name) stop_name
        from supplier group by 1""",
    "schedule": """select l_orderkey trip_id, l_linenumber::bigint stop_sequence,
        min(epoch(l_shipdate)::bigint) sched,
        max(case when l_quantity % 5 = 0 then (l_quantity * 60)::bigint end) delay,
        max(case when l_discount = 0
          then epoch(l_shipdate)::bigint + (l_quantity * 30)::bigint end) "time",
        case when max(case when l_quantity % 5 = 0 or l_discount = 0 then 1 end) = 1 then 'SCHEDULED'
          when bool_or(l_tax > 0.07) then 'NO_DATA' end relationship
        from lineitem group by 1, 2""",
    "trips": """select o_orderkey trip_id, o_orderpriority route_id,
        epoch(o_orderdate)::bigint start_s, o_orderstatus status, o_custkey custkey,
        o_orderdate "day" from orders""",
    "forms": """select doc_id seq, source || '/' || lang title, text body,
        case when doc_id % 10 = 0 then '2018/07/01' else '2018-07-01' end "date",
        case when toxic is not null then lang end author,
        case when quality = 0 then 'draft' else 'save' end "action"
        from documents left join labels using (doc_id)""",
    "valid": """select * from forms where author is not null and "date" like '____-__-__'""",
}

_NET = """select station_id, window_start, window_start + interval {span} window_end,
    sum(step)::bigint net, arg_max(num_bikes_available, seq) last_bikes, count(*) readings
    from (select *, abs(num_bikes_available - lag(num_bikes_available, 1, 0) over (
        partition by station_id, window_start order by seq)) step
      from (select *, time_bucket(interval {span}, ts) window_start from status))
    group by 1, 2"""
VIEWS["net_hour"] = _NET.format(span="'60 minutes'")
VIEWS["net_day"] = _NET.format(span="'1 day'")


def _with(names: str, body: str) -> str:
    views = ", ".join(f"{n} as ({VIEWS[n]})" for n in names.split())
    return f"with {views} {body}"


_MALFORMED = "(event_type = 'error' and value < 10)"
_STATUS_JSON = """'{"stationId":"' || station_id || '","num_bikes_available":' || n ||
    ',"num_bikes_disabled":' || n % 3 || ',"num_docks_available":' || n % 5 ||
    ',"num_docks_disabled":0,"is_installed":1,"is_renting":1,"is_returning":1}'"""
_STATUS_N = "(select *, num_bikes_available n from status)"

ORACLES = {
    "low_availability": _with("status info", """
        select seq, station_id, num_bikes_available, capacity,
          num_bikes_available::double / nullif(capacity, 0) ratio
        from status join info using (station_id)
        where num_bikes_available::double / nullif(capacity, 0) < 0.1"""),
    "feed_flatten": _with("status", """
        select seq // 100 snapshot, station_id, num_bikes_available,
          num_bikes_available % 3 num_bikes_disabled, num_bikes_available % 5 num_docks_available,
          0 num_docks_disabled, 1 is_installed, 1 is_renting, 1 is_returning from status"""),
    "feed_count": """select count(distinct event_id // 100) snapshots, count(*) stations,
        0::bigint empty_snapshots from events""",
    "to_topic_json": _with("status", f"""
        select station_id "key", {_STATUS_JSON} "value" from {_STATUS_N}
        union all
        select s_suppkey::varchar, '{{"stationId":"' || s_suppkey || '","name":"' || s_name ||
          '","latitude":' || s_nationkey || '.0,"longitude":' ||
          case when s_nationkey = 0 then '0' else (-s_nationkey)::varchar end || '.0,"capacity":' ||
          (s_nationkey % 7) * 20 || '}}' from supplier"""),
    "decode_status": _with("status", f"""
        select station_id, seq, num_bikes_available from status where not {_MALFORMED}"""),
    "decode_info": _with("versions", """
        select station_id, seq, case when capacity is not null then 'Station ' || station_id end name,
          capacity, capacity is null deleted from versions"""),
    "quarantine_split": _with("status", f"""
        select seq, {_MALFORMED} malformed,
          case when {_MALFORMED} then substr(json, 1, 20) else json end "value",
          case when not {_MALFORMED} then num_bikes_available end num_bikes_available
        from (select *, {_STATUS_JSON} json from {_STATUS_N})"""),
    "ktable_latest": _with("versions", """
        select station_id, 'Station ' || station_id name, capacity
        from (select station_id, capacity, row_number() over (
          partition by station_id order by seq desc) n from versions)
        where n = 1 and capacity is not null"""),
    "asof_lookup": _with("status versions", """
        select s.seq, s.station_id, s.num_bikes_available, v.capacity
        from status s asof left join versions v
          on s.station_id = v.station_id and s.seq >= v.seq"""),
    "net_delta": _with("status net_hour", "select * from net_hour"),
    "net_delta_daily": _with("status net_day", "select * from net_day"),
    "net_delta_changelog": _with("status", """
        select station_id, window_start, seq, num_bikes_available,
          (sum(step) over (partition by station_id, window_start order by seq
            rows between unbounded preceding and current row))::bigint net
        from (select *, abs(num_bikes_available - lag(num_bikes_available, 1, 0) over (
            partition by station_id, window_start order by seq)) step
          from (select *, time_bucket(interval '1 day', ts) window_start from status))"""),
    "turnover_ratio": _with("status info net_hour", """
        select station_id, window_start, net, capacity,
          net::double / nullif(capacity, 0) * 100.0 turnover
        from net_hour join info using (station_id)"""),
    "top_turnover": _with("status info net_day", """
        select window_start, rank, station_id, turnover from (
          select *, rank() over (partition by window_start
            order by turnover desc, station_id)::int rank
          from (select *, net::double / nullif(capacity, 0) * 100.0 turnover
            from net_day join info using (station_id)) where turnover is not null)
        where rank <= 10"""),
    "ticks_scan": """select event_type ticker, date_trunc('day', ts)::timestamp trade_date,
        value price from events""",
    "pair_fanout": _with("ticks tickers pairs", """
        select t1, t2, ticker, trade_date, round(price, 6) price
        from ticks join pairs on ticker = t1 or ticker = t2"""),
    "cogroup_counts": _with("ticks tickers pairs days day_windows", """
        select t1, t2, window_start, window_end, count(a) n_1, count(b) n_2, count(a + b) n_both
        from day_windows group by 1, 2, 3, 4"""),
    "pair_correlation": _with("ticks tickers pairs days day_windows correlations", """
        select t1, t2, window_start, window_end, round(corr, 6) corr from correlations"""),
    "pair_signals": _with("ticks tickers pairs days day_windows correlations", """
        select t1, t2, window_start, window_end, round(corr, 6) corr from correlations
        where corr < -0.75"""),
    "feed_entities": _with("updates", """
        select seq, 'T' || seq id, floor(epoch(ts))::bigint feed_time, 'FULL_DATASET' incrementality,
          case when not (u.event_type = 'error' and u.value < 5) then route_id end route_id,
          case when u.value < 250 then 3 end stop_times
        from updates u join events on seq = event_id"""),
    "trip_update_messages": _with("updates", """
        select '{' || concat_ws(',',
          case when not (event_type = 'error' and value < 5) then
            '"trip":{"tripId":"T' || seq || '","routeId":"' || route_id || '"}' end,
          case when value < 250 then '"stopTimeUpdate":[{"stopId":"' || stop_id || direction ||
            '","arrival":{"time":"' || arrival || '"}},{"stopId":"' || stop_id || direction ||
            '","departure":{"time":"' || arrival || '"}},{"arrival":{"time":"' || arrival ||
            '"}}]' end) || '}' "value" from updates"""),
    "stop_times": _with("updates arrivals", "select * from arrivals"),
    "next_arrival": _with("updates arrivals upcoming", f"""
        select route_id, stop_id, direction, min(arrival) arrival,
          (min(arrival) - {NOW}) % 3600 // 60 as minutes, (min(arrival) - {NOW}) // 60 as total_minutes
        from upcoming group by 1, 2, 3"""),
    "arrival_improvements": _with("updates all_upcoming improvements",
                                  "select * from improvements"),
    "arrival_message": _with("updates all_upcoming improvements stops", f"""
        select seq, 'Next ' || direction || ' bound ' || route_id || ' train will arrive at station '
          || stop_name || ' in ' || (arrival - {NOW}) % 3600 // 60 || ' minutes' message
        from improvements join stops using (stop_id)"""),
    "stop_lookup": _with("updates arrivals stops", """
        select seq, stop_id, direction, stop_name from arrivals left join stops using (stop_id)"""),
    "stop_unmatched": _with("updates arrivals stops", """
        select stop_id, count(*) arrivals from arrivals
        where stop_id not in (select stop_id from stops) group by 1"""),
    "feed_merge": _with("updates", """
        select id, seq, arrival from (
          select *, row_number() over (partition by id order by seq desc) n
          from (select route_id || '/' || stop_id || direction id, seq, arrival, value from updates
            where seq // 100 >= (select max(event_id // 100) from events where event_id // 100 % 4 = 0)))
        where n = 1 and value >= 10"""),
    "effective_arrival": _with("schedule", """
        select trip_id, stop_sequence, sched, coalesce("time", sched + delay) effective_arrival
        from schedule"""),
    "delay_propagation": _with("schedule", """
        , given as (select *, case when relationship <> 'NO_DATA'
            then coalesce("time" - sched, delay) end v from schedule)
        select trip_id, stop_sequence, sched, d effective_delay, sched + d expected from (
          select s.*, case when valued = 0
              then case when o_orderstatus = 'P' then 120 end::bigint
              else (select u.v from given u
                where u.trip_id = s.trip_id and u.stop_sequence = s.last_update) end d
          from (select *, max(case when relationship is not null then stop_sequence end) over w last_update,
              count(v) over w valued from given
              window w as (partition by trip_id order by stop_sequence
                rows between unbounded preceding and current row)) s
          left join orders on o_orderkey = trip_id)"""),
    "trip_completed": _with("schedule", """
        select trip_id, stop_sequence last_sequence, last_time,
          coalesce(last_time < 978307200, false) and unsure wrong_prediction,
          coalesce(last_time < 978307200, false) and not unsure completed
        from (select *, coalesce("time", sched + delay) last_time,
            coalesce(relationship = 'NO_DATA', false) unsure,
            row_number() over (partition by trip_id order by stop_sequence desc) n from schedule)
        where n = 1"""),
    "cancelled_trips": _with("trips", """
        , bounds as (select route_id, sum(start_s)::bigint // count(start_s) middle,
            max(start_s) last from trips group by 1)
        select trip_id, t.route_id, start_s from trips t join bounds b using (route_id)
        where (t.route_id = '1-URGENT' or start_s >= middle)
          and (t.route_id = '5-LOW'
            or start_s < case when t.route_id = '1-URGENT' then middle else last end)
          and trip_id not in (select trip_id from trips where status <> 'P')"""),
    "assigned_trips": _with("trips", "select trip_id, route_id from trips where status = 'F'"),
    "service_time": _with("trips", """
        select trip_id, strftime("day", '%Y%m%d') start_date,
          lpad((custkey % 30)::varchar, 2, '0') || ':' || lpad((trip_id % 60)::varchar, 2, '0') || ':'
            || lpad((custkey % 60)::varchar, 2, '0') start_time,
          start_s + custkey % 30 * 3600 + trip_id % 60 * 60 + custkey % 60 start_s from trips"""),
    "train_id_parts": _with("trips", """
        select trip_id,
          case status when 'P' then '0' when 'F' then '=' else '/' end || route_id[1] || ' '
            || lpad((custkey % 24)::varchar, 2, '0') || lpad((trip_id % 60)::varchar, 2, '0')
            || case when custkey % 2 = 0 then '+' else ' ' end || ' '
            || upper(substr(route_id, 3, 3)) || '/BBR' train_id,
          case status when 'P' then 'scheduled' when 'F' then 'reroute' else 'skip stop' end trip_type,
          route_id[1] line,
          (custkey % 24 * 3600 + trip_id % 60 * 60
            + case when custkey % 2 = 0 then 30 else 0 end)::int origin_seconds,
          upper(substr(route_id, 3, 3)) origin, 'BBR' destination
        from trips"""),
    "rerouted_stops": """
        select l_orderkey trip_id, l_linenumber stop_sequence, l_linenumber % 4 + 1 scheduled_track,
          (l_suppkey % 4 + 1)::int actual_track from lineitem
        where l_tax > 0 and l_linenumber % 4 <> l_suppkey % 4""",
    "countdown_stops": """
        select l_orderkey trip_id, l_linenumber stop_sequence from lineitem
        where l_orderkey not in (select l_orderkey from lineitem
          where l_tax > 0 and l_linenumber % 4 <> l_suppkey % 4)""",
    "vehicle_status": """
        select event_id seq, case when value < 20 then null when event_type = 'view' then 'STOPPED_AT'
          when event_type = 'click' then 'INCOMING_AT' else 'IN_TRANSIT_TO' end vehicle_status
        from events""",
    "translated_text": """
        select doc_id, case when lang = 'fr' then source || '/' || lang
          when n_chars % 2 = 0 then 'doc ' || doc_id
          when lang = 'en' then source || '/' || lang
          else 'doc ' || doc_id end text from documents""",
    "active_alerts": f"""
        select event_id id from (select *, floor(epoch(ts))::bigint as now_s from events)
        where event_type = 'view'
          or ((event_id % 7 = 0 or now_s <= {NOW})
            and (event_id % 11 = 0 or {NOW} < now_s + floor(value * 3600)::bigint))
          or (event_type = 'click' and now_s + 864000 <= {NOW} and {NOW} < now_s + 950400)""",
    "alert_targets": """
        with selectors as (select event_id id,
            case when event_id % 3 <> 0 then event_type end route_id,
            case when event_id % 5 <> 0 then lpad((user_id % 1000)::varchar, 3, '0') end stop_id
          from events),
        targets as (select distinct event_type route_id,
            lpad((user_id % 1000)::varchar, 3, '0') stop_id from events)
        select t.route_id, t.stop_id, count(*) alerts, max(id) last_id
        from targets t join selectors s
          on coalesce(s.route_id, s.stop_id) is not null
          and (s.route_id is null or s.route_id = t.route_id)
          and (s.stop_id is null or s.stop_id = t.stop_id)
        group by 1, 2""",
    "alert_targets_selectors": """
        with selectors as (select event_id id,
            case when event_id % 3 <> 0 then event_type end route_id,
            case when event_id % 5 <> 0 then lpad((user_id % 1000)::varchar, 3, '0') end stop_id
          from events
          union all select event_id, null, lpad((user_id % 1000)::varchar, 3, '0') from events
          where event_id % 2 = 0),
        targets as (select distinct event_type route_id,
            lpad((user_id % 1000)::varchar, 3, '0') stop_id from events)
        select t.route_id, t.stop_id, count(distinct id) alerts, max(id) last_id
        from targets t join selectors s
          on coalesce(s.route_id, s.stop_id) is not null
          and (s.route_id is null or s.route_id = t.route_id)
          and (s.stop_id is null or s.stop_id = t.stop_id)
        group by 1, 2""",
    "posts_load_malformed": """
        select case when doc_id % 7 <> 0 then doc_id::int end id,
          case when doc_id % 7 = 0 then '{"id":' || doc_id end "value" from documents""",
    "feed_malformed": "select event_id seq, event_id % 9 = 0 malformed from events",
    "source_stops": _with("stops", "select stop_id, stop_name from stops"),
    "source_tick_files": """select event_type ticker, date_trunc('day', ts)::timestamp trade_date,
        value price from events""",
    "source_status_feed": _with("status", """
        select station_id, num_bikes_available,
          num_bikes_available % 3 num_bikes_disabled, num_bikes_available % 5 num_docks_available,
          0 num_docks_disabled, 1 is_installed, 1 is_renting, 1 is_returning from status"""),
    "decode_quarantine": f"select event_id seq, {_MALFORMED} malformed from events",
    "posts_load": """select doc_id::int id, substr(source, 4)::int "userId",
        source || '/' || lang title, text body from documents""",
    "manifest_load": """select doc_id::int id, substr(source, 4)::int "userId",
        source || '/' || lang title, text body, lang ingest_ts from documents where lang <> 'de'""",
    "posts_scan": _with("forms valid", """
        select seq, title, body, "date"::timestamp "date", author from valid
        where "action" = 'save'"""),
    "validate_posts": _with("forms", """
        select seq, title, author, case when author is null then 'author'
          when "date" like '%/%' then 'date' end reason from forms"""),
    "route_posts": _with("forms valid", """
        select seq, title, body,
          case when "action" = 'draft' then 'entries' else 'table' end route from valid"""),
    "kv_upsert": _with("forms", """
        select title, arg_max(body, seq) body from forms group by 1"""),
    "log_partitions": """
        select year(ts)::varchar "year", month(ts)::varchar "month", day(ts)::varchar "day",
          hour(ts)::varchar "hour", count(*) records, ceil(count(*) / 10000)::bigint objects
        from events group by 1, 2, 3, 4""",
    "tag_route": """
        select event_id seq, event_type || '.access' tag,
          case when event_type = 'error' then 'log-errors'
            when event_type in ('click', 'view') then 'log-web' else 'log-messages' end topic
        from events""",
    "index_documents": """
        select 'log-messages+0+' || event_id doc_id, 'log-messages' index_name, props source
        from events""",
    "word_stream": """
        select conv_id, turn, (i - 1)::int position, words[i] word
        from (select *, string_split(text, ' ') words from conversations) m, range(1, len(words) + 1) r(i)""",
    "message_history": """
        select conv_id, nth // 1000 page, count(*) messages,
          (sum(count(*)) over (partition by conv_id))::bigint total,
          string_agg(text, chr(10) order by nth) history
        from (select *, row_number() over (partition by conv_id order by turn nulls first, text nulls first) - 1 nth
          from conversations) group by 1, 2""",
    "message_acks": """select conv_id, count(*) messages, 'Copy!' reply
        from conversations group by 1""",
    "reply_words": """
        select conv_id, messages, (i - 1)::int position, words[i] word
        from (select conv_id, count(*) messages,
            string_split('Five words make one answer', ' ') words from conversations group by 1) m,
          range(1, 6) r(i)""",
}

# Streaming runs end in the rows of their batch forms.
ORACLES |= {
    "stream_low_availability": ORACLES["low_availability"],
    "stream_net_delta_changelog": ORACLES["net_delta_changelog"],
    "stream_net_delta": _with("status net_hour",
                              "select station_id, window_start, window_end, net from net_hour"),
    "stream_ktable_latest": ORACLES["ktable_latest"],
    "stream_keyed_net_delta": ORACLES["net_delta_changelog"],
    "stream_pair_correlation": ORACLES["pair_correlation"],
    "stream_next_arrival": ORACLES["next_arrival"],
    "stream_arrival_improvements": _with("updates arrivals all_upcoming improvements",
                                         "select * from improvements").replace(
        "select * from updates where", "select * from arrivals where"),
    "stream_kv_upsert": ORACLES["kv_upsert"],
    "stream_save_forms": _with("forms valid", """
        select title, arg_max(body, seq) body, 'entries' route from valid
        where "action" = 'draft' group by 1
        union all select title, body, 'table' from valid where "action" = 'save'"""),
    "stream_log_fan_out": """
        select year(ts)::varchar "year", month(ts)::varchar "month", day(ts)::varchar "day",
          hour(ts)::varchar "hour", count(*) records, 'objects' sink from events group by 1, 2, 3, 4
        union all select null, null, null, null, count(*), 'log-messages' from events""",
}

ORACLES["landed_load"] = ORACLES["manifest_load"]
ORACLES["tag_route_indexed"] = ORACLES["tag_route"]
ORACLES["published_entries"] = ORACLES["kv_upsert"]
ORACLES["block_correlation"] = ORACLES["pair_correlation"]
ORACLES["stream_keyed_improvements"] = ORACLES["stream_arrival_improvements"]

# End-to-end plans: topics as they arrive, malformed records aside.
VIEWS |= {
    "good_status": f"select * from status where not {_MALFORMED}",
    "table_info": """select station_id, capacity from (select station_id, capacity, row_number() over (
        partition by station_id order by seq desc) n from versions) where n = 1 and capacity is not null""",
    "good_day": _NET.format(span="'1 day'").replace("from status", "from good_status"),
    "better": VIEWS["improvements"].replace("all_upcoming", "upcoming"),
}
_TURNOVER = """select station_id, window_start, net, capacity, net::double / nullif(capacity, 0) * 100.0 turnover
    from good_day join table_info using (station_id)"""
_COUNTDOWN = f"""select seq, route_id, stop_id, direction, arrival, (arrival - {NOW}) // 60 total_minutes,
    'Next ' || direction || ' bound ' || route_id || ' train will arrive at station '
      || stop_name || ' in ' || (arrival - {NOW}) % 3600 // 60 || ' minutes' message
    from better join stops using (stop_id)"""
ORACLES |= {
    "plan_signals": ORACLES["pair_signals"],
    "plan_low_availability": _with("status versions good_status table_info", """
        select station_id "key", station_id, num_bikes_available::varchar bikes, capacity::varchar capacity
        from good_status join table_info using (station_id)
        where num_bikes_available::double / capacity < 0.1"""),
    "plan_turnover": _with("status versions good_status table_info good_day", _TURNOVER),
    "plan_countdown": _with("updates arrivals upcoming better stops", _COUNTDOWN),
    "stream_countdown": _with("updates arrivals upcoming better stops",
                              f"select seq, message from ({_COUNTDOWN})"),
    "stream_top_turnover": ORACLES["top_turnover"],
}
