"""Composite operators, each DataFrame -> DataFrame."""

from .alerts import (arrivals, asked_pairs, attach_flag, best_donor, classify, cut_orders, discontinued_alert, donor_cover,
                     expand_donors, last_line_per_material, later_order_pairs, open_sales_lines, prepare_materials,
                     price_disagreement, quota_exceeded, quota_in_later_order, restock_asof, whole_order_feasible)
from .dimension import (active_sites, coded_text_lookup, latest_attributes, material_dimension, normalize_units,
                        shipped_materials, unit_pivot)
from .joins import (broadcast_if_small, count_distinct_over, expand_days, guarded_left_join, keyed_by_order, most_frequent,
                    next_event_after, split_by_date)
from .latest import latest_per_key
from .merge import OUTPUT_CONTRACT, may_ask_quota, merge_decisions, typed_output
from .temporal import (fiscal_labels, latest_stock, period_keys, period_start, project_demand, valid_at,
                       validity_interval)
