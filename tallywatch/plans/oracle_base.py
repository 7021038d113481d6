"""Named SQL pieces for the correctness check, composed into one WITH query per key."""
from __future__ import annotations

import re

PIECES: dict[str, str] = {}


def piece(name: str, sql: str) -> None:
    PIECES[name] = sql


def compose(final: str) -> str:
    """`final` preceded by every piece it needs, in dependency order."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z][a-z0-9_]*\b", sql)):
            if word in PIECES and word not in order:
                visit(PIECES[word])
                if word not in order:
                    order.append(word)

    visit(final)
    if not order:
        return final
    pieces = ",\n".join(f"{n} AS ({PIECES[n]})" for n in order)
    own = re.match(r"\s*with\s", final)
    return f"WITH {pieces}" + (f",\n{final[own.end():]}" if own else f"\n{final}")


# Columns named like pieces would pull them in, so pieces carry a prefix: z_.
DIDX = "date_diff('day', date '1995-01-01', {d})"


def _moment(day: str, hour: str) -> str:
    d = DIDX.format(d=day)
    return (f"({day}::timestamp + to_hours(({hour})::bigint) + to_minutes(case when {hour} = 23 and {d} % 29 <> 0 "
            f"then 55 else 0 end))")


def _lag(key: str) -> str:
    d = DIDX.format(d="date")
    return f"case when {d} % 41 = 0 then 90 when {d} % 13 = 0 and {key} % 2 = 0 then 60 else 2 end"


piece("z_li", f"""
    select *, l_shipdate::date as date, l_partkey % 24 as hour from lineitem""")
piece("z_li2", f"select *, {_moment('date', 'hour')} as moment from z_li")
piece("z_tr", f"""
    select date, moment + to_hours(case when l_suppkey % 97 = 0 then 24 else 0 end) as block_timestamp,
           {DIDX.format(d='date')} * 24 + hour as block_number, l_linenumber::bigint as log_index,
           l_orderkey::varchar as transaction_hash, l_returnflag as token,
           case when l_suppkey % 25 = 0 then '0x' || repeat('0', 64) else '0x' || lpad(l_suppkey::varchar, 64, '0') end as from_address,
           case when l_partkey % 40 = 7 then '0x' || repeat('0', 64) else '0x' || lpad(l_partkey::varchar, 64, '0') end as to_address,
           case l_linenumber when 7 then (l_partkey % 100) / 100.0::double when 6 then l_quantity else l_extendedprice end::double as amount,
           moment + to_hours({_lag('l_partkey')}) as last_modified
    from z_li2""")
piece("z_od", """
    select *, o_orderdate::date as date, o_custkey % 24 as hour,
           case when o_custkey % 10 < 7 then ['A', 'N', 'R'][(o_orderkey % 3 + 1)::int] end as direct_token from orders""")
piece("z_od2", f"select *, {_moment('date', 'hour')} as moment from z_od")
piece("z_tx", f"""
    select date, moment as block_timestamp, {DIDX.format(d='date')} * 24 + hour as block_number,
           o_orderkey % 40 as transaction_index, o_orderkey::varchar as hash,
           '0x' || lpad(o_custkey::varchar, 40, '0') as from_address,
           case when direct_token is null or o_orderkey % 53 = 0 then '0x' || lpad(o_orderkey::varchar, 40, '0')
                else case direct_token when 'A' then '0xaaaa' when 'N' then '0xbbbb' else '0xcccc' end end as to_address,
           direct_token, case when o_orderstatus = 'F' then 0 else 1 end::bigint as receipt_status,
           (21000 + 1000 * (o_custkey % 4))::bigint as receipt_gas_used,
           round(o_totalprice * 1000000)::bigint as receipt_effective_gas_price, 2::bigint as transaction_type,
           moment + to_hours({_lag('o_custkey')}) as last_modified
    from z_od2""")
piece("z_days", "select distinct l_shipdate::date as date from lineitem")
piece("z_hours", f"""
    select date, h as hour, {DIDX.format(d='date')} * 24 + h as number from z_days, unnest(range(24)) as u(h)""")
piece("z_bl", f"""
    select date, number, md5(number::varchar) as hash,
           case when number % 1511 = 7 then 'bad' else md5((number - 1)::varchar) end as parent_hash,
           {_moment('date', 'hour')} + to_hours(case when number % 3001 = 11 then 24 else 0 end
                + case when number % 1709 = 9 then -2 else 0 end) as timestamp,
           38::bigint as transaction_count, 15000000 + (number % 100) * 100000 as gas_used, 24850000::bigint as gas_limit,
           20000000000 + (number * 7919 % 1000) * 100000000 as base_fee_per_gas,
           {_moment('date', 'hour')} + to_hours(case when {DIDX.format(d='date')} % 41 = 0 then 72 else 1 end) as last_modified
    from z_hours, unnest(range(case when number % 2003 = 5 then 2 else 1 end)) as c(i)
    where number % 1009 <> 3""")
piece("z_calls", """
    select ts::date as date, ts as block_timestamp, ['A', 'N', 'R'][(user_id % 3 + 1)::int] as token, user_id as sender,
           event_type = 'error' as failed, (props::json->>'$.k')::bigint as gas, value as amount, event_id as number
    from events""")
piece("z_src", """
    select 'token_transfers' as source_table, date, 'lineitem.parquet' as file_name, block_number as block, last_modified as written,
           date_diff('second', block_timestamp, last_modified) as lag from z_tr
    union all select 'transactions', date, 'orders.parquet', block_number, last_modified,
           date_diff('second', block_timestamp, last_modified) from z_tx
    union all select 'blocks', date, 'lineitem.parquet', number, last_modified,
           date_diff('second', timestamp, last_modified) from z_bl""")
piece("z_load", """
    select source_table, date, count(*) as rows, count(distinct file_name) as files, min(block) as min_block,
           max(block) as max_block, min(written) as first_written, max(written) as last_written,
           quantile_cont(lag, 0.5)::double as median_lag_s, max(lag)::bigint as max_lag_s
    from z_src group by all""")
# The rule: bands of amounts by table; a transfer is direct where its transaction calls the token itself.
piece("z_bands", """
    select * from (values (1, 'under 10', '-inf'::double, 10.0::double), (2, '10 to 1k', 10, 1000), (3, '1k to 100k', 1000, 100000), (4, '100k and over', 100000, 'inf'::double))
        as b(place, band, low, high)""")
piece("z_direct", "select hash, direct_token from z_tx where direct_token is not null")
piece("z_labelled", """
    select t.*, band as amount_band, place as amount_band_order,
           if((transaction_hash, token) in (select (hash, direct_token) from z_direct), 'direct', 'via contract') as route
    from z_tr t join z_bands on amount >= low and amount < high""")
# Each transaction is one row of a cell first.
piece("z_cell", """
    select date, token, amount_band, amount_band_order, route, transaction_hash, count(*) as n, sum(amount) as v, list(distinct from_address) as f,
           list(distinct to_address) as r from z_labelled group by all""")
piece("z_pay", """
    select strftime(date, '%Y-%m') as month, date, token, amount_band, amount_band_order, route, concat_ws('|', date, token, amount_band, route) as cube_key,
           sum(n)::bigint as transfers, sum(v) as volume, count(*) as transactions, len(list_distinct(flatten(list(f)))) as senders,
           len(list_distinct(flatten(list(r)))) as receivers
    from z_cell group by date, token, amount_band, amount_band_order, route""")
piece("z_stgtx", """
    select *, receipt_status = 1 as succeeded,
           receipt_gas_used::double * receipt_effective_gas_price / 1e18 as fee_eth from z_tx""")
# The rule: direct calls of a day and token by outcome, their fees, and the middle fee of all.
piece("z_outcomes", """
    select date, direct_token as token, succeeded, count(*) as n, sum(fee_eth) as fees, list(fee_eth) as each from z_stgtx
    where direct_token is not null group by all""")
piece("z_health", """
    select *, failed_calls / direct_calls as failure_rate, strftime(date, '%Y-%m') as month, concat_ws('|', date, token) as health_key
    from (select date, token, sum(n)::bigint as direct_calls, sum(if(succeeded, 0, n))::bigint as failed_calls, sum(fees) as total_fee_eth,
        list_median(flatten(list(each))) as median_fee_eth from z_outcomes group by date, token)""")
# The rule: one row per day with blocks, what is missing from and doubled in its numbers, the day's transfers, and its loads.
piece("z_pipe_numbers", """
    select date, number, count(*) as copies, sum(base_fee_per_gas / 1e9) as fees from z_bl group by date, number""")
piece("z_pipe_blocks", """
    select date, sum(copies)::bigint as blocks, 1 + max(number) - min(number) - count(number) as missing_blocks,
           (sum(copies) - count(number))::bigint as duplicate_blocks, sum(fees) / sum(copies) as avg_base_fee_gwei from z_pipe_numbers group by date""")
piece("z_pipe_loads", """
    select date, sum(files)::bigint as source_files, (max(max_lag_s) / 3600.0)::double as max_load_lag_hours, max(last_written) as last_written,
           sum(if(source_table = 'token_transfers', rows, null))::bigint as source_transfer_rows,
           sum(if(source_table = 'transactions', rows, null))::bigint as source_transaction_rows from z_load group by date""")
piece("z_pipe", """
    select strftime(date, '%Y-%m') as month, b.*, (select nullif(count(*), 0) from z_tr t where t.date = b.date) as stablecoin_transfers,
           source_transfer_rows, source_transaction_rows, source_files, max_load_lag_hours, last_written
    from z_pipe_blocks b left join z_pipe_loads using (date)""")
