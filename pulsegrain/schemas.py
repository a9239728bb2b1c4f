"""Record shapes, silver columns and contract rules: the one source of truth.

Leaves of landed records are read as strings and coerced later, so that a
numeric string is a number and a bad scalar is a null, not a failed job.
"""

from __future__ import annotations

from pyspark.sql import types as T

SCORE_STATES = ("SCORED", "PENDING_SCORE", "UNSCORABLE")
RECORD_TYPES = ("cycles", "recovery", "sleep", "workouts")
KEYS = {"cycles": "cycle_id", "recovery": "cycle_id", "sleep": "sleep_id", "workouts": "workout_id"}


def _struct(spec: str) -> T.StructType:
    """'a b c' as string fields; 'x{a b}' nests."""
    fields, i = [], 0
    tokens = spec.replace("{", " { ").replace("}", " } ").split()

    def read(stop: bool) -> T.StructType:
        nonlocal i
        out = []
        while i < len(tokens):
            name = tokens[i]
            i += 1
            if name == "}":
                return T.StructType(out)
            if i < len(tokens) and tokens[i] == "{":
                i += 1
                out.append(T.StructField(name, read(True)))
            else:
                out.append(T.StructField(name, T.StringType()))
        return T.StructType(out)

    fields = read(False)
    return fields


#: Nested shapes of landed records; every leaf is a string.
RECORDS = {
    "cycles": _struct("id user_id created_at updated_at start end timezone_offset score_state score{strain kilojoule average_heart_rate max_heart_rate}"),
    "recovery": _struct("cycle_id sleep_id user_id created_at updated_at score_state score{user_calibrating recovery_score resting_heart_rate hrv_rmssd_milli spo2_percentage skin_temp_celsius}"),
    "sleep": _struct(
        "id cycle_id user_id created_at updated_at start end timezone_offset nap score_state score{stage_summary{total_in_bed_time_milli total_awake_time_milli total_no_data_time_milli total_light_sleep_time_milli"
        " total_slow_wave_sleep_time_milli total_rem_sleep_time_milli sleep_cycle_count disturbance_count} sleep_needed{baseline_milli need_from_sleep_debt_milli need_from_recent_strain_milli need_from_recent_nap_milli}"
        " respiratory_rate sleep_performance_percentage sleep_consistency_percentage sleep_efficiency_percentage}"
    ),
    "workouts": _struct(
        "id user_id created_at updated_at start end timezone_offset sport_name score_state score{strain average_heart_rate max_heart_rate kilojoule percent_recorded distance_meter altitude_gain_meter altitude_change_meter"
        " zone_durations{zone_zero_milli zone_one_milli zone_two_milli zone_three_milli zone_four_milli zone_five_milli}}"
    ),
}

#: How a silver column is read from a record: (column, path, kind). Kinds: ts,
#: long, int, double, bool, string, hours (milliseconds to hours). Paths under
#: score are null unless the record is scored.
SILVER: dict[str, list[tuple[str, str, str]]] = {
    "cycles": [
        ("cycle_id", "id", "long"), ("user_id", "user_id", "long"), ("created_at", "created_at", "ts"), ("updated_at", "updated_at", "ts"), ("start_at", "start", "ts"), ("end_at", "end", "ts"),
        ("timezone_offset", "timezone_offset", "string"), ("score_state", "score_state", "string"), ("strain", "score.strain", "double"), ("kilojoule", "score.kilojoule", "double"),
        ("average_heart_rate", "score.average_heart_rate", "int"), ("max_heart_rate", "score.max_heart_rate", "int"),
    ],
    "recovery": [
        ("cycle_id", "cycle_id", "long"), ("sleep_id", "sleep_id", "string"), ("user_id", "user_id", "long"), ("created_at", "created_at", "ts"), ("updated_at", "updated_at", "ts"),
        ("score_state", "score_state", "string"), ("user_calibrating", "score.user_calibrating", "bool"), ("recovery_score", "score.recovery_score", "int"),
        ("resting_heart_rate", "score.resting_heart_rate", "int"), ("hrv_rmssd_milli", "score.hrv_rmssd_milli", "double"), ("spo2_percentage", "score.spo2_percentage", "double"),
        ("skin_temp_celsius", "score.skin_temp_celsius", "double"),
    ],
    "sleep": [
        ("sleep_id", "id", "string"), ("cycle_id", "cycle_id", "long"), ("user_id", "user_id", "long"), ("created_at", "created_at", "ts"), ("updated_at", "updated_at", "ts"), ("start_at", "start", "ts"),
        ("end_at", "end", "ts"), ("timezone_offset", "timezone_offset", "string"), ("is_nap", "nap", "bool"), ("score_state", "score_state", "string"),
        *[(f"total_{n}_hours", f"score.stage_summary.total_{n}_time_milli", "hours") for n in ("in_bed", "awake", "no_data", "light_sleep", "slow_wave_sleep", "rem_sleep")],
        ("sleep_cycle_count", "score.stage_summary.sleep_cycle_count", "int"), ("disturbance_count", "score.stage_summary.disturbance_count", "int"),
        ("baseline_sleep_need_hours", "score.sleep_needed.baseline_milli", "hours"), ("sleep_debt_need_hours", "score.sleep_needed.need_from_sleep_debt_milli", "hours"),
        ("recent_strain_need_hours", "score.sleep_needed.need_from_recent_strain_milli", "hours"), ("recent_nap_need_hours", "score.sleep_needed.need_from_recent_nap_milli", "hours"),
        ("respiratory_rate", "score.respiratory_rate", "double"), *[(f"sleep_{n}_percentage", f"score.sleep_{n}_percentage", "double") for n in ("performance", "consistency", "efficiency")],
    ],
    "workouts": [
        ("workout_id", "id", "string"), ("user_id", "user_id", "long"), ("created_at", "created_at", "ts"), ("updated_at", "updated_at", "ts"), ("start_at", "start", "ts"), ("end_at", "end", "ts"),
        ("timezone_offset", "timezone_offset", "string"), ("sport_name", "sport_name", "string"), ("score_state", "score_state", "string"), ("strain", "score.strain", "double"),
        ("average_heart_rate", "score.average_heart_rate", "int"), ("max_heart_rate", "score.max_heart_rate", "int"),
        *[(n, f"score.{n}", "double") for n in ("kilojoule", "percent_recorded", "distance_meter", "altitude_gain_meter", "altitude_change_meter")],
        *[(f"zone_{i}_hours", f"score.zone_durations.zone_{n}_milli", "hours") for i, n in enumerate(("zero", "one", "two", "three", "four", "five"))],
    ],
}

_KINDS = {"ts": T.TimestampType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "hours": T.DoubleType(), "bool": T.BooleanType(), "string": T.StringType()}


def silver_type(table: str) -> T.StructType:
    """The silver schema of a table."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, _, kind in SILVER[table]])


_NULLABLE = {
    "cycles": {"end_at", "strain", "kilojoule", "average_heart_rate", "max_heart_rate"},
    "recovery": {"user_calibrating", "recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "spo2_percentage", "skin_temp_celsius"},
    "sleep": {name for name, path, _ in SILVER["sleep"] if path.startswith("score.")},
    "workouts": {name for name, path, _ in SILVER["workouts"] if path.startswith("score.")},
}
#: Columns that may be negative.
_SIGNED = {"recent_nap_need_hours", "altitude_gain_meter", "altitude_change_meter"}


def ranges(table: str) -> dict[str, tuple[float | None, float | None]]:
    """Allowed range of each measured column; None is open."""
    out: dict[str, tuple[float | None, float | None]] = {}
    for name, path, kind in SILVER[table]:
        if not path.startswith("score.") or kind == "bool" or name in _SIGNED:
            continue
        if name.endswith("_percentage") or name in ("recovery_score", "percent_recorded"):
            out[name] = (0.0, 100.0)
        elif name == "skin_temp_celsius":
            out[name] = (0.0, 60.0)
        else:
            out[name] = (0.0, None)
    return out


def required(table: str) -> list[str]:
    """Columns that may not be null."""
    return [name for name, _, _ in SILVER[table] if name not in _NULLABLE[table]]
