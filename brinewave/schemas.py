"""Schemas of the landed tables. Nothing is inferred from a sample; counts are nullable."""

from __future__ import annotations

SURVEYS = "survey_id string, survey_date date, site_id string, crew string"
SEINES = (
    "seine_id string, survey_id string, so_total int, pi_total int, cu_total int, co_total int, he_total int, "
    "ck_total int"
)
FISH_FIELD = (
    "ufn string, seine_id string, species string, fork_length_field string, lice_presence string, "
    "field_lice_id_protocol string"
)
FISH_LAB = "ufn string, fork_length double"
LICE_CURRENT = (
    "ufn string, seine_id string, lep_cope int, lam int, laf int, lgf int, cal_cope int, cam int, caf int, cgf int, "
    "chal_a_b int, unid_cope int, unid_chal int"
)
PROBE = "survey string, date date, temp double"

# A workbook is landed as one folder a sheet.
SHEETS = {
    "survey_data": SURVEYS,
    "seine_data": SEINES,
    "fish_field_data": FISH_FIELD,
    "sealice_field_data": LICE_CURRENT,
}
