"""The subpackage's queries and their SQL."""

from __future__ import annotations

from . import chat, decontaminate, licenses, neardup, packing, quality, repair, secrets, toxicity, warc

QUERIES = {
    "op1_license_dice": licenses.query,
    "op2_role_repair": chat.query,
    "op3_minmax_neardup": neardup.query,
    "op4_spaced_seeds": decontaminate.query,
    "op5_repair_tokens": repair.query,
    "op6_toxicity": toxicity.query,
    "op7_binary_packing": packing.query,
    "op8_decision_list": quality.query,
    "op9_secret_network": secrets.query,
    "op10_warc_derivatives": warc.query,
}
SQL = {"op1_license_dice": licenses.SQL}
