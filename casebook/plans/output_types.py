"""Result columns handed over as DOUBLE at the driver boundary, per query
(generated by tools/gen_output_types.py).

DECIMAL columns, and integer columns that hold NULLs: client libraries
convert these differently (Python Decimal vs float; pandas float64 vs
Int64), a DOUBLE crosses the same way everywhere. The library itself
keeps the exact types."""

DOUBLE_COLUMNS = {
    'bt_02': ['revenue_before_discounts', 'revenue_after_discounts'],
    'bt_03': ['total_discount_given'],
    'bt_06': ['25th_percentile_rev_per_trans', '50th_percentile_rev_per_trans', '75th_percentile_rev_per_trans'],
    'bt_06_intended': ['25th_percentile_rev_per_trans', '50th_percentile_rev_per_trans', '75th_percentile_rev_per_trans'],
    'bt_09': ['member'],
    'bt_10': ['total_revenue_for_product'],
    'bt_11': ['total_revenue_generated'],
    'bt_11_intended': ['total_revenue_generated', 'avg_discount_given'],
    'bt_13': ['revnue'],
    'bt_13_intended': ['revnue', 'discount'],
    'bt_c1': ['price', 'member'],
    'cb_09': ['product_id'],
    'cb_10': ['product_id'],
    'cb_11': ['product_id'],
    'db_06': ['amount_of_transaction'],
    'db_07': ['total_deposit_amount'],
    'db_09': ['deposit', 'purchase', 'withdrawal', 'left_over'],
    'db_09_intended': ['closing_balance'],
    'db_10': ['deposit', 'purchase', 'withdrawal', 'left_over'],
    'dm_04': ['total_sales'],
    'dm_10': ['prev_weeks_sales', 'after_weeks_sales', 'reduction_in_sales'],
    'dm_10_intended': ['before_sales', 'after_sales', 'sales_change'],
    'dm_11': ['prev_weeks_sales', 'after_weeks_sales', 'reduction_in_sales'],
    'dm_11_intended': ['before_sales', 'after_sales', 'sales_change'],
    'dm_12': ['prev_weeks_sales', 'after_weeks_sales', 'reduction_in_sales'],
    'dm_12_intended': ['before_sales', 'after_sales', 'sales_change'],
    'dm_c1': ['sales'],
    'dm_c10': ['sales'],
    'dm_c11': ['sales', 'avg_transaction'],
    'dm_c2': ['sales'],
    'dm_c3': ['sales'],
    'dm_c3_intended': ['sales', 'avg_transaction'],
    'dm_c4': ['sales'],
    'dm_c5': ['sales'],
    'dm_c6': ['sales'],
    'dm_c7': ['sales'],
    'dm_c8': ['sales'],
    'dm_c9': ['sales'],
    'dn_01': ['total_spent'],
    'dn_08': ['amount_spent'],
    'dn_09': ['points'],
    'dn_10': ['points'],
    'dn_10_intended': ['points'],
    'ff_04_intended': ['churn_percentage'],
    'ff_05_intended': ['percentage'],
    'ff_06_intended': ['next_plan', 'percentage'],
    'ff_07_intended': ['percentage'],
    'ff_12': ['payment'],
    'ff_12_intended': ['amount'],
    'pr_07': ['changed_orders', 'unchanged_orders'],
    'pr_19': ['amount'],
}

# DATE / TIMESTAMP result columns, handed over as ISO text ('yyyy-MM-dd',
# 'yyyy-MM-dd HH:mm:ss.ffffff'): clients turn them into date objects or
# datetime64 values of different units depending on the engine.
DATE_COLUMNS = {
    'cb_13_intended': ['visit_start_time'],
    'db_08_intended': ['month'],
    'db_09_intended': ['month'],
    'dm_01': ['week_date'],
    'dm_01_intended': ['week_date'],
    'dm_c1': ['week_date'],
    'dm_c10': ['week_date'],
    'dm_c11': ['week_date'],
    'dm_c2': ['week_date'],
    'dm_c3': ['week_date'],
    'dm_c3_intended': ['week_date'],
    'dm_c4': ['week_date'],
    'dm_c5': ['week_date'],
    'dm_c6': ['week_date'],
    'dm_c7': ['week_date'],
    'dm_c8': ['week_date'],
    'dm_c9': ['week_date'],
    'dn_06': ['order_date', 'join_date'],
    'dn_06_intended': ['order_date', 'join_date'],
    'dn_07': ['order_date', 'join_date'],
    'dn_07_intended': ['order_date', 'join_date'],
    'ff_02_intended': ['month_of_start'],
    'ff_11': ['basic_monthly_start'],
    'ff_12': ['start_date'],
    'ff_12_intended': ['payment_date'],
    'pr_c1': ['order_time'],
    'pr_c2': ['order_time'],
}

# the TIMESTAMP ones among them
TIMESTAMP_COLUMNS = {
    'cb_13_intended': ['visit_start_time'],
    'pr_c1': ['order_time'],
    'pr_c2': ['order_time'],
}
