"""The same queries in plain SQL over the given tables, written on their own."""

from __future__ import annotations

import re

from ..functions.columns import WHITESPACE
from ..schema import DOC_FIELDS
from ..search.analyze import STOP_WORDS
from ..search.stemming import STEP_2, STEP_3, STEP_4

W = f"'{WHITESPACE}'"


def strip(x: str) -> str:
    return f"trim({x}, {W})"


def nb(x: str) -> str:
    return f"nullif({strip(x)}, '')"


PARTY = "coalesce(nullif(trim(concat_ws(' ', p.first_name, p.middle_name, p.last_name)), ''), p.company_name, p.name)"
EMPLOYEE = "p.first_name || ' ' || coalesce(p.last_name, '')"
NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def as_number(x: str) -> str:
    return f"case when regexp_matches({strip(x)}, {NUMBER}) then try_cast({strip(x)} as double) end"


VIEWS = {
    "v_parties": """
        select case when c_mktsegment = 'AUTOMOBILE' then 'dev_env' else 'spar' end client_id, c_custkey id,
          case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Co ' || c_name
               when c_mktsegment = 'HOUSEHOLD' then '' end company_name,
          case c_mktsegment when 'AUTOMOBILE' then ' Ann' when 'HOUSEHOLD' then '' when 'FURNITURE' then c_name end first_name,
          case when c_nationkey < 8 then '' when c_nationkey < 16 then 'M' end middle_name,
          case when c_acctbal > 5000 then 'Smith' || c_nationkey when c_acctbal < 0 then '' end last_name,
          case when c_acctbal < 9000 then c_name end as name,
          case when c_nationkey <> 3 then c_nationkey::bigint end company_id,
          c_mktsegment as type,
          case when c_acctbal > 8000 then '' when c_acctbal > 2000 then lower(c_name) || '@mail.test' end email,
          case when c_mktsegment <> 'BUILDING' then 'all-' || lower(c_name) end email_ids,
          case when c_acctbal > 4000 then ' VAT ' || c_nationkey || chr(10) end vat_number,
          case when c_acctbal < -500 then 1 when c_acctbal between 0 and 60 then null else 0 end is_deleted
        from customer""",
    "v_orders": """
        select case when o_orderpriority = '1-URGENT' then 'dev_env' else 'spar' end client_id, o_orderkey id,
          'SO-' || o_orderkey series_number, case when o_totalprice > 25000 then o_custkey end customer_id,
          o_orderstatus status, o_orderdate::date as date,
          case o_orderstatus when 'F' then 'n/a'
               when 'P' then ' ' || o_totalprice::decimal(18,2)::varchar || chr(9) end grand_total,
          case when o_orderpriority <> '2-HIGH' then o_totalprice end total_amount,
          case when o_orderstatus <> 'F' then floor(o_totalprice / 100000)::bigint end company_id,
          case o_orderpriority when '1-URGENT' then chr(9) || ' rush it' || chr(10) when '2-HIGH' then '   '
               when '3-MEDIUM' then 'medium ' when '5-LOW' then '' end narration,
          o_orderpriority priority,
          case when o_orderstatus = 'P' and o_totalprice > 400000 then 1 when o_totalprice < 5000 then null else 0 end is_deleted,
          o_orderstatus delivery_status,
          case when o_orderpriority = '1-URGENT' then 'soon' when o_orderpriority = '2-HIGH' then ' '
               else ' ' || o_orderdate::date::varchar || chr(10) end expected_closing_date
        from orders""",
    "v_items": """
        select 'spar' client_id, p_partkey id, p_name as name, p_brand || '-' || p_partkey sku, p_type as type, p_brand brand,
          case when p_size < 25 then p_retailprice::decimal(18,2)::varchar when p_size = 30 then 'call us' end sales_price,
          case when p_size > 40 then 'size ' || p_size end description,
          case when p_size = 50 then 1 else 0 end is_deleted
        from part""",
    "v_part_companies": """
        select distinct l_partkey part_id, nullif(l_suppkey, 0) company_id from lineitem""",
    "v_bom": """
        select 'spar' client_id, p_partkey id, case when p_size > 10 then p_partkey + p_size end item_id,
          'kit ' || p_name as name, p_type version_number, case when p_size < 30 then 'open' end status,
          case when p_size = 49 then 1 else 0 end is_deleted
        from part""",
    "v_transfers": """
        select 'spar' client_id, l_orderkey * 10 + l_linenumber id, s_nationkey::bigint source_id,
          case when l_quantity < 48 then c_nationkey::bigint end destination_id,
          l_returnflag operation_type, l_linestatus status, l_shipdate::date as date, l_quantity quantity
        from lineitem left join supplier on l_suppkey = s_suppkey left join orders on l_orderkey = o_orderkey
          left join customer on o_custkey = c_custkey""",
    "v_requests": """
        select l_orderkey * 10 + l_linenumber id, 'PR-' || l_orderkey || '-' || l_linenumber series_number,
          l_linenumber department_id, case when l_returnflag <> 'N' then l_suppkey end vendor_id,
          l_linestatus status, l_shipdate::date as date
        from lineitem""",
    # Joined rows of the specs.
    "live_parties": "select * from v_parties where is_deleted = 0",
    "r_orders": f"""
        select o.* exclude (company_id), coalesce(o.company_id, p.company_id) company_id, {PARTY} customer_name
        from v_orders o left join v_parties p on p.id = o.customer_id and p.client_id = o.client_id
        where o.is_deleted = 0""",
    "r_invoices": f"""
        select o.* exclude (company_id, date), o.date + 30 bill_date, o.date + 30 as date,
          case when o.status <> 'O' then o.status end approval_status,
          coalesce(o.company_id, p.company_id) company_id, {PARTY} vendor_name
        from v_orders o left join v_parties p on p.id = o.customer_id and p.client_id = o.client_id
        where o.is_deleted = 0""",
    "r_items": """
        select i.*, c.company_id from v_items i left join v_part_companies c on c.part_id = i.id where i.is_deleted = 0""",
    "r_bom": """
        select b.*, i.name item_name, c.company_id from v_bom b left join v_items i on i.id = b.item_id
          join v_part_companies c on c.part_id = b.id
        where b.is_deleted = 0""",
    "r_transfers": """
        select t.*, a.n_name source_name, b.n_name destination_name
        from v_transfers t left join nation a on a.n_nationkey = t.source_id left join nation b on b.n_nationkey = t.destination_id""",
    "r_requests": f"""
        select r.*, r.status approval_status, d.r_name department_name, {PARTY} vendor_name
        from v_requests r left join region d on d.r_regionkey = r.department_id
          left join v_parties p on p.id = r.vendor_id and p.client_id = 'spar'""",
    "r_expenses": f"""
        select o.*, {EMPLOYEE} employee_name
        from v_orders o left join v_parties p on p.id = o.customer_id and p.client_id = o.client_id
        where o.is_deleted = 0""",
}


def title(label: str, *parts: str) -> str:
    return f"concat_ws(' · ', '{label}', {', '.join(nb(p) for p in parts)})"


def prose(label: str, **fields: str) -> str:
    said = ", ".join(f"'{n.replace('_', ' ')} is ' || {nb(c)}" for n, c in fields.items())
    details = f"nullif(concat_ws(', ', {said}), '')"
    return f"'This is a {label}' || coalesce(' where ' || {details}, '')"


AMOUNT = f"coalesce({as_number('grand_total')}, total_amount)"
BAD_CLOSING = f"({nb('expected_closing_date')} is not null and try_cast({strip('expected_closing_date')} as date) is null)"
DISPLAY = "coalesce(nullif(company_name, ''), nullif(concat_ws(' ', nullif(first_name, ''), nullif(middle_name, ''), nullif(last_name, '')), ''))"
FULL = f"concat_ws(' ', nullif(first_name, ''), nullif(middle_name, ''), nullif(last_name, ''))"
PARTY_TEXT = f"""concat_ws(', ',
    'This is a party' || coalesce(case when nullif(company_name, '') is not null then ' with company name ' else ' with name ' end || {DISPLAY}, ''),
    case when {nb('type')} is not null then 'party type is ' || type end,
    case when {nb('vat_number')} is not null then 'vat number is ' || vat_number end,
    case when {nb('email')} is not null then 'email is ' || email end)"""
RESOLVED = f"coalesce({nb(FULL)}, nullif(name, ''), nullif(company_name, ''))"
ORDER_TEXT = prose("sales order", series_number="series_number", customer="customer_name", status="status",
                   delivery_status="delivery_status", narration="narration")

VIEWS |= {
    "d_orders": f"""
        select client_id, 'sl_sales_orders:' || id id, id source_id, 'sl_sales_orders' doc_type, 'sales' module,
          coalesce(company_id::varchar, '0') company_id, {title('Sales Order', 'series_number', 'customer_name')} title,
          series_number reference, status, date, {AMOUNT} amount, {ORDER_TEXT} text_content,
          nullif(customer_name, '') party_name, null::varchar company_name, null::varchar approval_status,
          null::varchar email, delivery_status, null::varchar party_type, null::varchar item_type, null::date bill_date,
          null::double quantity, try_cast({strip('expected_closing_date')} as date) expected_closing_date,
          null::double sales_price, priority, narration
        from r_orders where not {BAD_CLOSING}""",
    "d_parties": f"""
        select client_id, 'parties:' || id id, id source_id, 'parties' doc_type, 'account' module,
          coalesce(company_id::varchar, '0') company_id, {title('Party', DISPLAY)} title, null::varchar reference,
          null::varchar status, null::date date, null::double amount, {PARTY_TEXT} text_content, {RESOLVED} party_name,
          company_name, null::varchar approval_status, coalesce(nullif(email, ''), email_ids) email,
          null::varchar delivery_status, type party_type, null::varchar item_type, null::date bill_date,
          null::double quantity, null::date expected_closing_date, null::double sales_price, null::varchar priority
        from live_parties""",
    "d_items": f"""
        select client_id, 'items:' || id || ':' || coalesce(nullif(company_id, 0)::varchar, '') id, id source_id,
          'items' doc_type, 'inventory' module, coalesce(company_id::varchar, '0') company_id, {title('Item', 'name')} title,
          sku reference, null::varchar status, null::date date, {as_number('sales_price')} amount,
          {prose('item product', name='name', sku='sku', item_type='type', brand='brand', description='description')} text_content,
          name party_name, null::varchar company_name, null::varchar approval_status, null::varchar email,
          null::varchar delivery_status, null::varchar party_type, type item_type, null::date bill_date,
          null::double quantity, null::date expected_closing_date, {as_number('sales_price')} sales_price, null::varchar priority
        from r_items where not (sales_price is not null and ({as_number('sales_price')}) is null)""",
}

SHOWN = ("client_id, id, source_id, doc_type, module, company_id, title, reference, status, date, amount, text_content,"
         " party_name, company_name, approval_status, email, delivery_status, party_type, item_type, bill_date, quantity,"
         " expected_closing_date, sales_price, priority")

VIEWS |= {
    "d_union": f"""
        select {SHOWN} from d_orders union all select {SHOWN} from d_parties union all select {SHOWN} from d_items
        union all
        select client_id, 'purchase_invoices:' || id, id, 'purchase_invoices', 'account', coalesce(company_id::varchar, '0'),
          {title('Purchase Invoice', 'series_number', 'vendor_name')}, series_number, null, date, {AMOUNT},
          {prose('purchase invoice', series_number='series_number', vendor='vendor_name', approval_status='approval_status',
                 narration='narration')},
          nullif(vendor_name, ''), null, approval_status, null, null, null, null, bill_date, null, null, null, priority
        from r_invoices
        union all
        select client_id, 'mf_bom:' || id || ':' || coalesce(nullif(company_id, 0)::varchar, ''), id, 'mf_bom', 'manufacturing',
          coalesce(company_id::varchar, '0'), {title('Bill of Materials', 'name', 'item_name')}, version_number, status, null, null,
          {prose('bill of materials bom', name='name', item='item_name', version_number='version_number', status='status')},
          name, null, null, null, null, null, null, null, null, null, null, null
        from r_bom
        union all
        select client_id, 'stock_transfers:' || id, id, 'stock_transfers', 'inventory', '0',
          {title('Stock Transfer', 'operation_type', 'source_name', 'destination_name')}, null, status, date, null,
          {prose('stock transfer', operation_type='operation_type', source_location='source_name',
                 destination_location='destination_name', status='status')},
          null, null, null, null, null, null, null, null, quantity, null, null, null
        from r_transfers
        union all
        select 'spar', 'pr_purchase_requests:' || id, id, 'pr_purchase_requests', 'purchase', '0',
          {title('Purchase Request', 'series_number', "coalesce(nullif(vendor_name, ''), department_name)")}, series_number, null,
          date, null, {prose('purchase request', series_number='series_number', department='department_name',
                             approval_status='approval_status')},
          nullif(vendor_name, ''), null, approval_status, null, null, null, null, null, null, null, null, null
        from r_requests
        union all
        select client_id, 'expense_reimbursements:' || id, id, 'expense_reimbursements', 'account', coalesce(company_id::varchar, '0'),
          {title('Expense Reimbursement', 'series_number', 'employee_name')}, series_number, null, date, {AMOUNT},
          {prose('expense reimbursement', series_number='series_number', employee='employee_name')},
          nullif(employee_name, ''), null, null, null, null, null, null, null, null, null, null, priority
        from r_expenses""",
    "v_texts": """
        select o_orderkey id,
          case when o_orderstatus = 'O' then o_totalprice::decimal(18,2)::varchar else
            case o_orderpriority when '1-URGENT' then '12.5' when '2-HIGH' then ' 7' || chr(10) when '3-MEDIUM' then 'abc'
              when '4-NOT SPECIFIED' then '1d' when '5-LOW' then '-1e3' end end number,
          case when o_orderstatus = 'O' then chr(9) || o_orderdate::date::varchar || ' ' else
            case o_orderpriority when '1-URGENT' then 'soon' when '2-HIGH' then '' when '3-MEDIUM' then '2001-02-30'
              when '5-LOW' then ' ' || chr(10) end end as day,
          o_orderdate moment, o_totalprice > 250000 flag, o_totalprice::decimal(18,2) price, o_custkey as role
        from orders""",
    # Stored documents of the orders and a second load of the open ones.
    "s_orders": "select client_id, module, doc_type, source_id, id, status from d_orders",
    "v_tenants": """
        select case r_name when 'AFRICA' then 'spar' when 'AMERICA' then 'dev_env' else replace(lower(r_name), ' ', '_') end client_id
        from region""",
    "v_events": """
        select event_id::varchar msg_id, value as amount, user_id,
          case event_type when 'signup' then 'c' when 'view' then 'r' when 'error' then 'd' else 'u' end op,
          case when value < 0.5 then '' when value > 250 then 'no_such_table' else 'parties' end tab,
          case when value < 20 then 'cdc_dev_env.shared_db.parties' when value > 300 then 'cdc_gone.shared_db.parties'
               else 'cdc_spar.shared_db.parties' end stream,
          event_type = 'click' wrapped
        from events""",
    "v_messages": """
        select *,
          '{"op": "' || op || '", "before": ' || case when op = 'd' and amount > 1 then '{"id": ' || user_id || ', "name": "x"}' else 'null' end
          || ', "after": ' || case when op <> 'd' and amount > 1.5 then '{"id": ' || user_id || ', "name": "x"}' else 'null' end
          || ', "source": {"table": "' || tab || '", "db": "shared_db"}}' body
        from v_events""",
    "v_raw": """
        select msg_id, stream, case when amount between 100 and 101 then '' when amount between 101 and 102 then 'default'
            when amount between 102 and 103 then split_part(body, '"source"', 1)
            when wrapped then '{"payload": ' || body || '}' else body end as value
        from v_messages""",
    "v_json": """
        select msg_id, stream, value, coalesce(json_valid(value) and value <> '', false) ok,
          case when coalesce(json_valid(value), false) and value <> '' then coalesce(json_extract(value::json, '$.payload'), value::json) end j
        from v_raw""",
    "v_parsed": """
        select msg_id, stream, value,
          case stream when 'cdc_spar.shared_db.parties' then 'spar' when 'cdc_dev_env.shared_db.parties' then 'dev_env' end client_id,
          case when ok then json_extract_string(j, '$.source.table') end tab,
          coalesce(case when ok then json_extract_string(j, '$.op') end, 'c') op,
          case when ok then try_cast(json_extract_string(j, '$.before.id') as bigint) end before_id,
          case when ok then try_cast(json_extract_string(j, '$.after.id') as bigint) end after_id,
          ok
        from v_json""",
    "v_reasons": """
        select *, case when client_id is null then 'no_route' when coalesce(value, '') = '' then 'empty'
            when not ok then 'malformed' when coalesce(tab, '') = '' then 'no_table' end skip_reason
        from v_parsed""",
    "v_classified": """
        select msg_id, stream, value, client_id, tab, op,
          case when op = 'd' then before_id else after_id end key_id,
          coalesce(skip_reason, case when tab <> 'parties' then 'unknown_table'
            when op = 'd' and before_id is null then 'no_before_id' when op <> 'd' and after_id is null then 'no_id' end) why
        from v_reasons""",
    "v_actions": """
        select *, case when why = 'no_before_id' then 'dead' when why is not null then 'skip' when op = 'd' then 'delete' else 'upsert' end action
        from v_classified""",
    "v_upserts": "select distinct client_id, key_id id from v_actions where action = 'upsert'",
    "v_deletes": "select distinct client_id, key_id id from v_actions where action = 'delete'",
    "v_changes": """
        select client_id, 'del_key' kind, 100::bigint seq, 'parties' doc_type, id source_id, null::varchar id, null::varchar title from v_deletes
        union all
        select u.client_id, case when d.id is null then 'del_key' else 'put' end, case when d.id is null then 100 else 101 end,
          'parties', u.id, d.id, d.title
        from v_upserts u left join d_parties d on d.source_id = u.id and d.client_id = u.client_id""",
}

TOKEN = (
    r"[\p{Han}\p{Hiragana}]|(?:[\p{L}\p{M}]+(?:[.:·''’][\p{L}\p{M}]+)*|\p{N}+(?:[.,;''’]\p{N}+)*|_+)+"
)


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN}')"


SYNONYMS = """
    select * from (values (0, 'po'), (0, 'purchase order'), (1, 'so'), (1, 'sales order'), (2, 'do'), (2, 'delivery order'),
      (3, 'grn'), (3, 'goods receipt'), (3, 'goods received note'), (4, 'rfq'), (4, 'request for quotation'),
      (4, 'request for quote'), (5, 'bom'), (5, 'bill of materials'), (6, 'je'), (6, 'journal entry'), (7, 'cn'),
      (7, 'credit note'), (8, 'dn'), (8, 'debit note'), (9, 'vra'), (9, 'vendor return'), (10, 'inv'), (10, 'invoice')) v(g, phrase)"""

VIEWS |= {
    "t_docs": f"""
        select doc_id, list_concat([], flatten(list_transform({tokens('text')}, lambda t:
          case when length(t) > 255 then regexp_extract_all(t, '.{{1,255}}') else [t] end))) toks from documents""",
    "t_terms": "select doc_id, len(toks) as length, unnest(toks) term from t_docs",
    "t_index": "select doc_id, length, term, count(*) tf from t_terms group by all",
    "t_size": "select count(*) n, avg(len(toks)) avgdl from t_docs where len(toks) > 0",
    "t_asked": f"select item_id query_id, unnest({tokens('text')}) term from benchmark",
    "t_wanted": "select query_id, term, count(*) qtf from t_asked group by all",
    "t_df": "select term, count(*) df from t_index group by term",
    "t_scores": """
        select query_id, i.doc_id id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
            / (tf + 1.2 * (0.25 + 0.75 * length / avgdl))), 6) score
        from t_wanted join t_index i using (term) join t_df using (term), t_size
        group by query_id, i.doc_id""",
    "t_hits": """
        select * from (select *, row_number() over (partition by query_id order by score desc, id) as rank from t_scores)
        where rank <= 50""",
    "k_scores": """
        select b.item_id query_id, d.vec_id id,
          round(1 / (2 - list_cosine_similarity(q.embedding::double[], d.embedding::double[])), 6) score
        from benchmark b join embeddings q on q.vec_id = b.item_id, embeddings d""",
    "k_hits": """
        select * from (select *, row_number() over (partition by query_id order by score desc, id) as rank from k_scores)
        where rank <= 50""",
    "k_cells": "select label, unnest(embedding)::double x, generate_subscripts(embedding, 1) pos from embeddings",
    "k_means": "select label, pos, avg(x) x from k_cells group by all",
    "k_centres": "select label::bigint query_id, list(x order by pos) c from k_means group by label",
    "m_text": """
        select query_id, id, case when s = 0 then 0.001 else s end s from (select *, case when mx = mn then 1 else (score - mn) / (mx - mn) end s
          from (select *, min(score) over (partition by query_id) mn, max(score) over (partition by query_id) mx from t_hits))""",
    "m_vector": """
        select query_id, id, case when s = 0 then 0.001 else s end s from (select *, case when mx = mn then 1 else (score - mn) / (mx - mn) end s
          from (select *, min(score) over (partition by query_id) mn, max(score) over (partition by query_id) mx from k_hits))""",
    "v_search": """
        select n_nationkey::bigint query_id, case when n_regionkey < 3 then 'spar' else 'dev_env' end client_id,
          case n_regionkey when 1 then ['sales', 'account'] when 2 then ['account'] end modules,
          case when n_nationkey < 10 then ['O', 'P'] when n_nationkey < 15 then ['F'] end statuses,
          case when n_nationkey < 20 then date '1996-01-01' + n_nationkey * 30 end date_from,
          case when n_nationkey > 5 then date '1999-01-01' + n_nationkey * 20 end date_to,
          case when n_nationkey <> 4 then n_nationkey + 1 else 20 end lim, case when n_nationkey <> 6 then n_nationkey * 2 else 0 end skip
        from nation""",
    "v_found": """
        select query_id, d.id, d.date, d.status, lim, skip,
          row_number() over (partition by query_id order by d.date desc nulls last, d.id) as rank,
          count(*) over (partition by query_id) total
        from v_search q join d_orders d on d.client_id = q.client_id and (modules is null or list_contains(modules, d.module))
          and (statuses is null or list_contains(statuses, d.status)) and (date_from is null or d.date >= date_from)
          and (date_to is null or d.date <= date_to)""",
    "v_synonyms": SYNONYMS,
    "y_words": f"select id, {tokens('title')} w from d_orders",
    "y_places": "select id, w, unnest(generate_series(1, len(w))) pos from y_words",
    "y_spans": "select id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') phrase from y_places, generate_series(1, 4) s(n) where pos + n - 1 <= len(w)",
    "y_matches": "select id, pos, n, phrase, g from y_spans join v_synonyms using (phrase)",
    "y_added": """
        select m.id, m.pos, unnest(string_split(v.phrase, ' ')) term, unnest(generate_series(0, len(string_split(v.phrase, ' ')) - 1)) off
        from y_matches m join v_synonyms v on v.g = m.g and v.phrase <> m.phrase""",
    "y_all": """
        select id, w[pos] term, pos from y_places union all select id, term, pos + off from y_added""",
    "v_config": """
        select case when n_nationkey > 20 then n_name when n_regionkey = 2 then 'same_id' else lower(n_name) end client_id,
          case when n_regionkey = 4 then null when n_nationkey = 7 then 'db.seven' else 'shared_db' end db_name,
          case when n_regionkey = 3 then 'cdc_three' when n_nationkey = 0 then ' ' else 'cdc_' || lower(n_name) end prefix
        from nation""",
}


# Stems of the distinct words, one step a view, with the usual regular expressions for the
# measure of a word: consonant runs C and vowel runs V.
C, V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
HAS_VOWEL, SHORT = f"^(?:{C}[aeiouy]|[aeiou])", f"^{C}[aeiouy][^aeiouwxy]$"
SOME, ONE, MORE = (f"{HAS_VOWEL}[aeiou]*{C}{rest}" for rest in ("", f"({V})?$", f"{V}{C}"))


def cut(suffix: str, n: int | None = None) -> str:
    return f"left(w, length(w) - {len(suffix) if n is None else n})"


def replaced(rules: tuple[tuple[str, str], ...]) -> str:
    cases = [f"when w like '%{a}' then case when regexp_matches({cut(a)}, '{SOME}') then {cut(a)} || '{b}' else w end" for a, b in rules]
    return f"case {' '.join(cases)} else w end"


def dropped() -> str:
    cases = []
    for suffix in STEP_4:
        stem = cut(suffix, 3 if suffix in ("sion", "tion") else None)
        cases.append(f"when w like '%{suffix}' then case when regexp_matches({stem}, '{MORE}') then {stem} else w end")
    return f"case {' '.join(cases)} else w end"


def stems(words: str) -> dict[str, str]:
    """Views turning the distinct words of a view into p_stems (word, w)."""
    return {
        "p_1a": f"""select word, case when length(word) < 3 then word when w like '%sses' or w like '%ies' then {cut('', 2)}
            when w like '%s' and w not like '%ss' then {cut('', 1)} else w end w from (select distinct term word, term w from {words})""",
        "p_1b": f"""select word, w old, case when w like '%eed' then null when w like '%ed' and regexp_matches({cut('ed')}, '{HAS_VOWEL}') then {cut('ed')}
            when w like '%ing' and regexp_matches({cut('ing')}, '{HAS_VOWEL}') then {cut('ing')} end w from p_1a""",
        "p_1bb": f"""select word, case when length(word) < 3 then old
            when w is null then case when old like '%eed' and regexp_matches(left(old, length(old) - 3), '{SOME}') then left(old, length(old) - 1) else old end
            when regexp_matches(w, '(at|bl|iz)$') then w || 'e'
            when right(w, 1) = right(left(w, length(w) - 1), 1) and regexp_matches(w, '[^aeiouylsz]$') then {cut('', 1)}
            when right(w, 1) = right(left(w, length(w) - 1), 1) and regexp_matches(w, '[lsz]$') then w
            when regexp_matches(w, '{ONE}') and regexp_matches(w, '{SHORT}') then w || 'e' else w end w from p_1b""",
        "p_1c": f"""select word, case when length(word) > 2 and w like '%y' and regexp_matches({cut('y')}, '{HAS_VOWEL}') then {cut('y')} || 'i' else w end w from p_1bb""",
        "p_2": f"select word, case when length(word) < 3 then w else {replaced(STEP_2)} end w from p_1c",
        "p_3": f"select word, case when length(word) < 3 then w else {replaced(STEP_3)} end w from p_2",
        "p_4": f"select word, case when length(word) < 3 then w else {dropped()} end w from p_3",
        "p_5a": f"""select word, case when length(word) > 2 and w like '%e' and (regexp_matches({cut('e')}, '{MORE}')
            or (regexp_matches({cut('e')}, '{ONE}') and not regexp_matches({cut('e')}, '{SHORT}'))) then {cut('e')} else w end w from p_4""",
        "p_stems": f"select word, case when length(word) > 2 and w like '%ll' and regexp_matches({cut('l')}, '{MORE}') then {cut('l')} else w end w from p_5a",
    }


STOPS = ", ".join(f"'{w}'" for w in sorted(STOP_WORDS))
ENGLISH = {
    "e_terms": "select doc_id, regexp_replace(term, '(''|’)s$', '') term from t_terms",
    "e_words": f"select * from e_terms where term not in ({STOPS})",
    **stems("e_words"),
    "e_index": "select doc_id, w term, count(*) tf from e_words join p_stems on word = term group by all",
    "e_lengths": "select doc_id, count(*) as length from e_words group by doc_id",
}


def domain(texts: str) -> dict[str, str]:
    """Views giving g_index (id, length, term, tf) of texts (id, x): synonyms, stop words, stems."""
    return {
        "g_words": f"select id, {tokens('x')} w from ({texts})",
        "g_places": "select id, w, unnest(generate_series(1, len(w))) pos from g_words",
        "g_spans": """select id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') phrase
            from g_places, generate_series(1, 4) s(n) where pos + n - 1 <= len(w)""",
        "g_matches": "select id, pos, n, phrase, g from g_spans join v_synonyms using (phrase)",
        "g_added": """select m.id, m.pos, unnest(string_split(v.phrase, ' ')) term,
              unnest(generate_series(0, len(string_split(v.phrase, ' ')) - 1)) off
            from g_matches m join v_synonyms v on v.g = m.g and v.phrase <> m.phrase""",
        "g_all": "select id, w[pos] term, pos from g_places union all select id, term, pos + off from g_added",
        "g_kept": f"select * from g_all where term not in ({STOPS})",
        **stems("g_kept"),
        "g_lengths": "select id, count(distinct pos) as length from g_kept group by id",
        "g_index": "select id, length, w term, count(*) tf from g_kept join p_stems on word = term join g_lengths using (id) group by all",
    }


MODULES = {
    "account": "sales_invoices purchase_invoices payment_entries credit_notes debit_notes journal_entries parties companies"
               " employees user budgets expense_reimbursements cash_expenses assets asset_transfers",
    "inventory": "items warehouse_location inventory_adjustments bin_transfers stock_transfers",
    "sales": "sl_sales_orders sl_quotation sl_delivery_orders sl_customer_returns sl_customer_return_grn sl_opportunity_parties"
             " sl_promotions",
    "purchase": "pr_purchase_orders pr_purchase_requests pr_rfqs pr_rfq_responses pr_purchase_order_grns pr_vras"
                " pr_delivery_orders pr_purchase_agreements",
    "manufacturing": "mf_work_orders mf_bom mf_build_orders mf_job_cards mf_production_plan mf_equipments mf_gate_registers",
    "rental": "rn_cross_hire_summary rn_delivery_order_grn",
    "document": "drive",
}
TABLES = ", ".join(f"('{m}', '{t}')" for m, names in MODULES.items() for t in names.split())
SQL_TYPES = {"string": "varchar", "date": "date", "double": "double", "bigint": "bigint"}


def every_field(have: tuple[str, ...]) -> str:
    """All document fields but the vector, null where a table has none."""
    fields = [f for f in DOC_FIELDS if f.name != "embedding"]
    return ", ".join(
        f'"{f.name}"' if f.name in have else f'null::{SQL_TYPES[f.type.simpleString()]} "{f.name}"' for f in fields
    )


ORDER_FIELDS = ("id", "source_id", "doc_type", "module", "company_id", "title", "reference", "status", "date", "amount",
                "text_content", "party_name", "delivery_status", "expected_closing_date", "priority", "narration")


def state(changes: str) -> str:
    """Newest put per id of (client_id, doc_type, source_id, id, status, seq), under deletes of the same shape."""
    return f"""
        , puts as (select * from ({changes}) where kind = 'put'
            qualify row_number() over (partition by client_id, id order by seq desc) = 1),
        dels as (select * from ({changes}) where kind <> 'put')
        select client_id, id, status, seq::bigint seq from puts p where not exists (
          select 1 from dels d where d.client_id = p.client_id and d.seq >= p.seq
            and (d.kind = 'del_tenant' or (d.kind = 'del_type' and d.doc_type = p.doc_type)
              or (d.kind = 'del_key' and d.doc_type = p.doc_type and d.source_id = p.source_id)))"""


def stored(seq_in: int, extra: str = "") -> str:
    return f"""select 'put' kind, client_id, doc_type, source_id, id, status, 1 seq from s_orders
        union all select 'put', client_id, doc_type, source_id, id, 'X', {seq_in} from s_orders where status = 'O' {extra}"""


QUERIES = {
    "scan_active": "select id, status, date from v_orders where client_id = 'spar' and is_deleted = 0",
    "project_override": "select client_id, id, date, company_id, vendor_name from r_invoices",
    "doc_title": "select id, title from d_orders",
    "doc_prose": "select id, text_content from d_orders",
    "text_generic": f"""
        select id, concat_ws(' ', 'company name: ' || {nb('company_name')}, 'first name: ' || {nb('first_name')},
          'middle name: ' || {nb('middle_name')}, 'last name: ' || {nb('last_name')}, 'name: ' || {nb('name')},
          'type: ' || {nb('type')}, 'email: ' || {nb('email')}, 'email ids: ' || {nb('email_ids')},
          'vat number: ' || {nb('vat_number')}) as text
        from v_parties""",
    "extract_amount": f"select id, {AMOUNT} amount from v_orders",
    "coerce_float": f"select id, {as_number('number')} as value from v_texts",
    "coerce_str": """
        select id, flag::int::varchar flag, price::varchar price, role::varchar as role, nullif(id, 0)::varchar reference from v_texts""",
    "normalise_date": f"""
        select id, try_cast({strip('day')} as date) as day,
          {nb('day')} is not null and try_cast({strip('day')} as date) is null bad, moment::date moment
        from v_texts""",
    "resolve_party_name": f"select id, {RESOLVED} party_name from v_parties",
    "truthy_or": """
        select id, coalesce(nullif(email, ''), email_ids) email, coalesce(nullif(first_name, ''), last_name) as first from v_parties""",
    "doc_id": "select id, source_id, company_id from d_items",
    "embed_input": f"""
        select id, case when party_type <> 'BUILDING' then {strip("title || ' ' || text_content")} else text_content end embed_input
        from d_parties""",
    "sql_party_name": f"select p.id, {PARTY} party_name from v_parties p",
    "sql_concat_null": f"select p.id, {EMPLOYEE} employee_name from v_parties p",
    "party_text": "select id, title, text_content from d_parties",
    "join_left_dim": "select client_id, id, customer_id, customer_name, company_id from r_orders",
    "join_dim_twice": "select id, source_name source_location_name, destination_name destination_location_name from r_transfers",
    "join_two_dims": "select id, department_name, vendor_name, approval_status from r_requests",
    "join_junction_left": "select id, company_id, type item_type from r_items",
    "join_junction_inner": "select id, company_id, item_name from r_bom",
    "documents_union": "select * from d_union",
    "tenant_override": f"""
        select o.client_id, 'sl_opportunity_parties:' || o.id id, {title('Sales Opportunity', PARTY, 'o.priority')} title,
          coalesce(p.company_id::varchar, '0') company_id, o.total_amount amount,
          {prose('sales opportunity', party=PARTY, stage='o.priority', narration='o.narration')} text_content
        from v_orders o left join v_parties p on p.id = o.customer_id and p.client_id = o.client_id
        where o.is_deleted = 0""",
    "build_documents_full": f"select client_id, {every_field(ORDER_FIELDS)} from d_orders",
    "build_documents_narrow": f"""
        select client_id, id, source_id, doc_type, module, company_id, title, reference, status, date, amount, text_content,
          null::varchar party_name, approval_status, null::varchar transaction_type, p.email, null::varchar phone
        from (select * exclude (email) from d_parties) d join (select client_id c, id i, email from v_parties) p on p.i = d.source_id and p.c = d.client_id""",
    "doc_rejects": f"""
        select client_id, 'sl_sales_orders' doc_type, id source_id, 'sl_sales_orders:' || id id,
          'bad_date:expected_closing_date' reason
        from r_orders where {BAD_CLOSING}
        union all
        select client_id, 'items', id, 'items:' || id || ':' || coalesce(company_id::varchar, ''), 'bad_amount'
        from r_items where sales_price is not null and ({as_number('sales_price')}) is null""",
    "embed_documents_vectors": f"""
        , words as (select id, unnest(string_split_regex(lower({strip("title || ' ' || text_content")}), '\\s+')) w from d_orders),
        hashed as (select id, ('0x' || substr(md5(w), 1, 8))::bigint h from words where w <> ''),
        cells as (select id, (h % 64)::int bucket, sum(case when h >= 2147483648 then 1 else -1 end) x from hashed group by all)
        select id, bucket, round((x / sqrt(sum(x * x) over (partition by id)))::float::double, 4) as value from cells where x <> 0
        qualify true""",
    "dimension_drift": """
        select case when label < 5 then 'spar' else 'dev_env' end client_id, case when label = 0 then 'account' else 'sales' end module,
          32 dimension, count(*) documents
        from embeddings where label in (3, 7) group by all""",
    "sync_upsert": state(stored(11)),
    "full_reindex": state(stored(11, "union all select 'del_type', 'spar', 'sl_sales_orders', null, null, null, 10")),
    "recreate_indices": state(stored(11, "union all select 'del_tenant', 'spar', null, null, null, null, 10")),
    "delete_by_source_id": state(stored(31, "union all select 'del_key', client_id, doc_type, source_id, null, null, 20 from s_orders where status = 'F'")),
    "upsert_apply": """
        , live as (
          select client_id, source_id, case when source_id in (select id from v_upserts u where u.client_id = d.client_id) then 101 else 1 end seq
          from d_parties d
          where source_id in (select id from v_upserts u where u.client_id = d.client_id)
             or source_id not in (select id from v_deletes x where x.client_id = d.client_id))
        select client_id || '_account' index_name, seq::bigint seq, count(*) documents, sum(source_id)::bigint ids from live group by all""",
    "store_end_to_end": """
        select client_id, id, doc_type, title, amount from d_orders
        union all
        select client_id, id, doc_type, title, amount from d_parties d
        where not exists (select 1 from v_deletes x where x.client_id = d.client_id and x.id = d.source_id)
           or exists (select 1 from v_upserts u where u.client_id = d.client_id and u.id = d.source_id)""",
    "sync_counts": f"""
        , rows_ as (select client_id, 'sl_sales_orders' doc_type, {BAD_CLOSING} bad from r_orders
          union all select client_id, 'items', sales_price is not null and ({as_number('sales_price')}) is null from r_items)
        select client_id, doc_type, count(*) filter (not bad) indexed, count(*) filter (bad) errors from rows_
        group by grouping sets ((client_id, doc_type), (client_id))""",
    "job_status_latest": """
        select 'job-' || user_id job_id, 'spar' client_id, case when max_by(event_type, ts) = 'error' then 'failed' else 'running' end status,
          max_by(event_id, ts) indexed
        from events where user_id < 100 group by user_id""",
    "job_summary": """
        , per_type as (select user_id, event_type, sum(event_id) i, sum(length(props)) e, max(value) > 200 bad from events group by all)
        select 'job-' || user_id job_id, 'spar' client_id, case when bool_or(bad) then 'partial' else 'ok' end status,
          sum(case when bad then 0 else i end)::bigint indexed, sum(case when bad then 1 else e end)::bigint errors, count(*) total_tables,
          coalesce(string_agg(event_type, ',' order by event_type) filter (bad), '') failed_tables
        from per_type group by user_id""",
    "cdc_parse": "select msg_id, client_id, tab \"table\", op, before_id, after_id, skip_reason from v_reasons",
    "cdc_classify": """
        select msg_id, action, case when action in ('delete', 'upsert') then key_id end row_id, why skip_reason from v_actions""",
    "cdc_compact": """
        select client_id, 'parties' "table", id, 'delete' action from v_deletes
        union all select client_id, 'parties', id, 'upsert' from v_upserts""",
    "cdc_refetch": """
        select p.client_id, p.id, p.name, p.type party_type from live_parties p join v_upserts u on u.id = p.id and u.client_id = p.client_id""",
    "cdc_soft_delete": """
        select u.client_id, u.id from v_upserts u where not exists (select 1 from live_parties p where p.id = u.id and p.client_id = u.client_id)""",
    "cdc_apply": "select * from v_changes",
    "cdc_lag": """
        select case e.stream when 'cdc_spar.shared_db.parties' then 'spar' else 'dev_env' end client_id,
          (count(*) - count(*) filter (x.ts < timestamp '2024-01-20') + count(*) filter (x.event_type = 'error'))::bigint lag
        from v_events e join events x on x.event_id::varchar = e.msg_id
        where e.stream <> 'cdc_gone.shared_db.parties' group by e.stream""",
    "cdc_backlog": "select stream, count(*) depth from v_events group by stream having count(*) > 1000",
    "dead_letter_split": """
        select 'stream-' || event_type stream, event_id as position, floor(value / 20)::bigint deliveries,
          case when floor(value / 20) >= 5 then 'dead' else 'live' end fate
        from events qualify row_number() over (partition by event_type order by event_id) <= 50""",
    "dead_letters": "select value, msg_id original_id, stream, why reason from v_actions where action = 'dead'",
    "stream_route": "select msg_id, stream, client_id from v_parsed",
    "stream_map": f"""
        , tables as (select * from (values {TABLES}) v(module, tab)),
        owned as (select * from (values ('spar'), ('dev_env')) v(client_id))
        select 'cdc_' || client_id || '.shared_db.' || tab stream, client_id, tab "table", module, client_id || '_' || module index_name,
          coalesce(n, 0) events
        from v_tenants join owned using (client_id), tables
          left join (select stream s, count(*) n from v_events group by stream) on s = 'cdc_' || client_id || '.shared_db.' || tab""",
    "route_violations": """
        select client_id, 'missing_db_name' violation from v_config where db_name is null or trim(db_name) = ''
        union select client_id, 'missing_cdc_topic_prefix' from v_config where prefix is null or trim(prefix) = ''
        union select client_id, 'dot_in_db_name' from v_config where contains(db_name, '.')
        union select client_id, 'bad_client_id' from v_config where not regexp_matches(client_id, '^[a-z][a-z0-9_]{1,30}$')
        union select client_id, 'duplicate_client_id' from v_config group by client_id having count(*) > 1
        union select c.client_id, 'shared_routing_key' from v_config c join (select prefix, db_name from v_config
          where prefix is not null and db_name is not null group by all having count(*) > 1) using (prefix, db_name)""",
    "tenant_isolation": """
        , all_docs as (select client_id, module from d_orders union all select client_id, module from d_parties)
        select client_id || '_' || module index_name, 1::bigint tenants, count(*) documents from all_docs group by client_id, module""",
    "analyze_terms": "select doc_id, length::int as length, term, tf::int tf from t_index",
    "analyze_english": "select doc_id, length::int as length, term, tf::int tf from e_index join e_lengths using (doc_id)",
    "analyze_domain": "select id, length::int as length, term, tf::int tf from g_index",
    "bm25_domain": """
        , size as (select count(*) n, avg(length) avgdl from (select distinct id, length from d_index)),
        wanted as (select id query_id, term, tf qtf from q_index),
        df as (select term, count(*) df from d_index group by term),
        scores as (select query_id, i.id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
            / (tf + 1.2 * (0.25 + 0.75 * length / avgdl))), 6) score
          from wanted join d_index i using (term) join df using (term), size group by query_id, i.id)
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from scores) where rank <= 10""",
    "field_indexes": """
        select 'title' field, id, term, tf::int tf from g_index
        union all select 'narration', id, w, count(*)::int from n_words join n_p_stems on word = term group by id, w
        union all select 'party_name', id, term, count(*)::int from n_party group by id, term""",
    "expand_synonyms": """
        , lengths as (select id, count(distinct pos) as length from y_all group by id)
        select id, length::int as length, term, count(*)::int tf from y_all join lengths using (id) group by all""",
    "term_stats": "select term, count(*) df, sum(tf)::bigint tf from t_index group by term",
    "bm25_topk": "select query_id, id, score, rank::int as rank from t_hits where rank <= 10",
    "knn_topk": """
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from (
            select query_id, vec_id id, round(1 / (2 - list_cosine_similarity(c, embedding::double[])), 6) score
            from k_centres, embeddings))
        where rank <= 10""",
    "knn_mixed_lengths": """
        , sized as (select vec_id id, case when label < 5 then 'spar' else 'dev_env' end client_id,
            case when label < 5 then embedding else embedding[1:32] end v from embeddings),
        asked as (select client_id, id query_id, v from sized where id % 20 = 0)
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from (
            select query_id, s.id, round(1 / (2 - list_cosine_similarity(a.v::double[], s.v::double[])), 6) score
            from asked a join sized s using (client_id)))
        where rank <= 5""",
    "knn_bad_vectors": """
        , good as (select vec_id id, embedding v from embeddings where vec_id % 7 not in (0, 1, 2))
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from (
            select a.id query_id, g.id, round(1 / (2 - list_cosine_similarity(a.v::double[], g.v::double[])), 6) score
            from good a, good g where a.id % 20 = 0))
        where rank <= 5""",
    "join_small_key_types": """
        select o_orderkey id, n_name small_name, r_name decimal_name
        from orders left join nation on n_nationkey = case when o_orderkey % 3 <> 0 then o_custkey % 40 end
          left join region on r_regionkey = case when o_orderkey % 4 <> 0 then o_custkey % 7 end""",
    "store_compact_then_late_put": "select client_id, id, 'O' status, 101::bigint seq from s_orders where status = 'O'",
    "store_compact_then_late_delete": "select client_id, id, status, 1::bigint seq from s_orders where status <> 'O'",
    "rejects_after_compact": """
        select client_id, 'sl_sales_orders' doc_type, id source_id, 'bad_date:expected_closing_date' reason from r_orders
        where {BAD_CLOSING}""".replace("{BAD_CLOSING}", BAD_CLOSING),
    "cdc_apply_override": f"""
        , keys as (select distinct user_id id from events)
        select k.id source_id, case when o.id is null then 'del_key' else 'put' end kind, case when o.id is not null then {title('Sales Opportunity', PARTY, 'o.priority')} end as title,
          case when o.id is not null then coalesce(p.company_id::varchar, '0') end company_id
        from keys k left join (select * from v_orders where is_deleted = 0 and client_id = 'spar') o on o.id = k.id
          left join v_parties p on p.id = o.customer_id and p.client_id = o.client_id""",
    "sync_with_overrides": """
        select client_id, id, doc_type, case when client_id = 'dev_env' then 'again ' || title else title end title from d_orders
        union all select client_id, id, doc_type, title from d_parties where client_id = 'spar'
        union all select client_id, replace(id, 'parties:', 'people:'), 'people', title from d_parties where client_id = 'dev_env'""",
    "hybrid_search": """
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from (
            select query_id, id, round(0.3 * coalesce(t.s, 0) + 0.7 * coalesce(v.s, 0), 6) score
            from m_text t full join m_vector v using (query_id, id)))
        where rank <= 10""",
    "hybrid_fallback": """
        select query_id, id, score, rank::int as rank from (
          select *, row_number() over (partition by query_id order by score desc, id) as rank from (
            select query_id, id, round(coalesce(t.score, 0) + coalesce(v.score, 0), 6) score
            from t_hits t full join k_hits v using (query_id, id)))
        where rank <= 10""",
    "search_filtered": """
        select query_id, id, date, status, rank::int as rank, total from v_found where rank > skip and rank <= skip + lim""",
    "search_text": f"""
        , docs as (select client_id, id, {tokens('text_content')} toks from d_orders),
        idx as (select client_id, id, len(toks) as length, unnest(toks) term from docs),
        tfs as (select client_id, id, length, term, count(*) tf from idx group by all),
        sizes as (select client_id, count(*) n, avg(len(toks)) avgdl from docs group by client_id),
        dfs as (select client_id, term, count(*) df from tfs group by all),
        words as (select client_id, query_id, unnest(string_split(case when query_id < 8 then 'rush it order' when query_id < 16
          then 'medium status o' else 'narration f rush' end, ' ')) term from v_search),
        scores as (select query_id, i.id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
            / (tf + 1.2 * (0.25 + 0.75 * length / avgdl))), 6) score
          from words join tfs i using (client_id, term) join dfs using (client_id, term) join sizes using (client_id) group by query_id, i.id),
        found as (select query_id, f.id, score, lim, skip, count(*) over (partition by query_id) total,
            row_number() over (partition by query_id order by score desc, f.id) as rank
          from v_found f join scores using (query_id, id))
        select query_id, id, score, rank::int as rank, total from found where rank > skip and rank <= skip + lim""",
    "search_exact": """
        select client_id, id, doc_type from d_parties where party_type in ('MACHINERY', 'AUTOMOBILE')
        union all select client_id, id, doc_type from d_orders where status = 'O'""",
    "search_highlight": f"""
        , parts as (select doc_id, list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)), lambda p: trim(p)) s, source from documents),
        marked as (select doc_id, case when source = 'src3' then '<em>src3</em>' end title,
          nullif(array_to_string(list_filter(list_transform(s, lambda p: array_to_string(list_transform(
            regexp_extract_all(p, '{TOKEN}|(?s:.)'), lambda w: case when lower(w) in ('the', 'und', 'les', 'src3')
              then '<em>' || w || '</em>' else w end), '')), lambda p: contains(p, '<em>')), '|'), '') t from parts)
        select doc_id id, case when title is not null then 'title' when t is not null then 'text_content' end first_field,
          title, t text_content from marked""",
}


def _renamed(views: dict[str, str], prefix: str) -> dict[str, str]:
    """The same views under other names, so that one statement can use them twice."""
    names = "|".join(views)
    again = lambda text: re.sub(rf"\b({names})\b", lambda m: prefix + m[1], text)
    return {prefix + name: again(text) for name, text in views.items()}


#: Views only some statements use, in place of or besides the common ones.
OWN_VIEWS = {
    "analyze_english": ENGLISH,
    "analyze_domain": domain("select id, text_content x from d_orders"),
    "field_indexes": {
        **domain("select id, title x from d_orders"),
        "n_terms": f"select id, regexp_replace(unnest({tokens('narration')}), '(''|’)s$', '') term from d_orders",
        "n_words": f"select * from n_terms where term not in ({STOPS})",
        **_renamed(stems("n_words"), "n_"),
        "n_party": f"select id, unnest({tokens('party_name')}) term from d_orders",
    },
    "bm25_domain": {
        **_renamed(domain("select doc_id id, text x from documents"), "a_"),
        **_renamed(domain("select item_id id, text x from benchmark"), "b_"),
        "d_index": "select * from a_g_index", "q_index": "select * from b_g_index",
    },
}


def _used(sql: str, views: dict[str, str]) -> set[str]:
    """The views a statement uses, directly or through other views."""
    direct = views.keys() & set(re.findall(r"\w+", sql))
    return direct.union(*(_used(views[v], views) for v in direct))


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in QUERIES.items():
        known = VIEWS | OWN_VIEWS.get(name, {})
        used = _used(sql, known)
        once = [v for v in known if "p_" in v or v.endswith("_index")]
        views = ",\n".join(f"{v} as {'materialized ' if v in once else ''}({text})" for v, text in known.items() if v in used)
        sql = sql.strip()
        if views:
            sql = f"with {views} {sql}"
        elif sql.startswith(","):
            sql = f"with {sql[1:]}"
        out[name] = sql
    return out
