-- Billed revenue by month, partner and product for paid statements.
-- Tables: statement_lines, statements, organizations, product_sku_dim. Parameters: :month_start, :month_end.
-- Statements meet their organisation before their lines, so the largest table is shuffled for one join only,
-- and products are joined to the totals instead of the lines.
with paid as (
    select s.statement_id, o.partner_type
    from statements s
    join organizations o on s.organization_id = o.organization_id
    where s.status = 'F'
),
totals as (
    select l.reportmonth, p.partner_type, l.sku,
           cast(sum(l.amount) as decimal(38, 2)) as amount,
           count(*) as n_lines
    from statement_lines l
    join paid p on l.statement_id = p.statement_id
    where l.payment_date >= :month_start
      and l.payment_date < :month_end
      and l.amount <> 0
    group by l.reportmonth, p.partner_type, l.sku
    having sum(l.amount) <> 0
)
select t.reportmonth, t.partner_type, t.sku, d.product_group, t.amount, t.n_lines
from totals t
left join product_sku_dim d on t.sku = d.sku
