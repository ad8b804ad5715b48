"""Scalar rules: pure ``Column -> Column`` functions, JVM-side, codegen-friendly."""

from . import constants
from .guards import clip, classify, is_missing, nan_to_null
from .ndvi import (band_pair, health_class, health_index, ndvi_guarded, ndvi_is_masked,
                   ndvi_masked, valid_ndvi)
from .paths import (base_name, date_text, day_number, is_ndvi_output, is_raster,
                    is_series_raster, ndvi_output_path, parent_name, parse_date_text)
from .rules import (disease_advice, disease_risk_class, disease_risk_score, domain_violations,
                    profit_floored, profit_plain, risk_code_label, roi_class_a, roi_class_b,
                    roi_guarded, roi_plain, scenario_advice, stress_advice, stress_class,
                    trend_colour, trend_direction, water_stress_basic, water_stress_climate,
                    yield_class)

__all__ = [n for n in dir() if not n.startswith("_")]
