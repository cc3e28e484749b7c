"""DataFrame operators: gates, lookup join, cleaning with quarantine, sums, top-N."""

from chargepulse.operators.gates import (
    notify_business_gate, notify_interface_gate, notify_ods_gate, request_gate, notify_gate,
)
from chargepulse.operators.lookup import lookup_join
from chargepulse.operators.clean import (
    parse_notify, clean_notify, clean_request, clean_topup, ods_detail,
    notify_rows, request_rows, topup_rows, good, quarantined, enforce, province_lookup,
)
from chargepulse.operators.spread import spread
from chargepulse.operators.aggregate import vector_sum, with_failures
from chargepulse.operators.rank import ranked
from chargepulse.operators.topn import top_n, sort_desc

__all__ = [
    "notify_business_gate", "notify_interface_gate", "notify_ods_gate", "request_gate",
    "notify_gate", "lookup_join",
    "parse_notify", "clean_notify", "clean_request", "clean_topup", "ods_detail",
    "notify_rows", "request_rows", "topup_rows", "good", "quarantined", "enforce",
    "province_lookup", "spread",
    "vector_sum", "with_failures", "ranked", "top_n", "sort_desc",
]
