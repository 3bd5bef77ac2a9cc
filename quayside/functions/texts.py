"""Alert texts.

Fixed values: the decision texts of the original job, verbatim, in the order
of the decision codes.  They are output values (``DecisionDescription`` and
the per-alert ``Alert`` columns), so they must stay byte-identical.  English
glosses are given in the comments.  Every operator takes its texts as
parameters with these defaults.
"""

# -- fixed values, begin ------------------------------------------------------
# 1: "Re-place the order / correct the price."
PRICE_ALERT = "Переразместить/скорректировать цену.\n"
# 2: "Attention. A product withdrawn from the range was ordered"
DISCONTINUED_ALERT = "Внимание. Заказан продукт выведенный из ассортимента"
# 3: "Quota in a later order, must be taken off the orders:" + one line per order
LATER_ORDER_HEADER = "Квота в дальнем заказе, необходимо снять с заказов:"
LATER_ORDER_SEPARATOR = "\n "
LATER_ORDER_ITEM = ("", " (", " cases)")
LATER_ORDER_TRAILER = "\n"
# 4: "The quota is exceeded by <n> cases. Top-4 customers with the most free quota:"
QUOTA_PARTS = ("Имеется превышение квоты на ", " cases.\n", "ТОП-4 клиента с наибольшей свободной квотой:\n", "\n")
# 5: "Move the shipment date to the restock date <date>" / "Not in this week's production plan."
RESTOCK_FOUND = ("Перенести дату отгрузки на дату пополнения ", "\n")
RESTOCK_NOT_FOUND = "Товара нет в плане производства на текущей неделе.\n"
# 6: "Move the order's shipment to warehouse <a or b>. Service level rises by <n>%"
DONOR_PARTS = ("Перенести отгрузку заказа на склад ", ". Уровень сервиса повысится на ", "%\n")
DONOR_SEPARATOR = " или "
# -- fixed values, end --------------------------------------------------------
