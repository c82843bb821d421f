"""Declarative scoring specification.

Everything the operators need to know about the survey lives here as plain
Python data: the indicator scales, which indicators are "lower is worse",
the index weights, the score formula, the risk bands and the option banks.
Operators take a ``Spec`` so any other survey can be scored by passing a
different one; ``DEFAULT_SPEC`` is the configuration the original pipeline
ships with.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original configuration for equal results).
# ---------------------------------------------------------------------------

# Indicator order, scale minimum and maximum, in schema order.
INDICATORS: list[tuple[str, int, int]] = [
    ("anxiety_level", 0, 21),
    ("self_esteem", 0, 30),
    ("mental_health_history", 0, 1),
    ("depression", 0, 27),
    ("headache", 0, 5),
    ("blood_pressure", 1, 3),
    ("sleep_quality", 0, 5),
    ("breathing_problem", 0, 5),
    ("noise_level", 0, 5),
    ("living_conditions", 0, 5),
    ("safety", 0, 5),
    ("basic_needs", 0, 5),
    ("academic_performance", 0, 5),
    ("study_load", 0, 5),
    ("teacher_student_relationship", 0, 5),
    ("future_career_concerns", 0, 5),
    ("social_support", 0, 3),
    ("peer_pressure", 0, 5),
    ("extracurricular_activities", 0, 5),
    ("bullying", 0, 5),
]

LABEL_COL = "stress_level"
LABEL_NAMES = {0: "Low (0)", 1: "Moderate (1)", 2: "High (2)"}

# Indicators where a lower value means more stress.
INVERTED = [
    "self_esteem",
    "sleep_quality",
    "living_conditions",
    "safety",
    "basic_needs",
    "academic_performance",
    "teacher_student_relationship",
    "social_support",
    "extracurricular_activities",
]

# Composite indices: (indicator, weight, inverted-in-this-index), in the
# order the terms are summed.
INDEX_TERMS: dict[str, list[tuple[str, float, bool]]] = {
    "emotional_strain": [
        ("anxiety_level", 0.30, False),
        ("depression", 0.35, False),
        ("mental_health_history", 0.15, False),
        ("self_esteem", 0.20, True),
    ],
    "physical_stress": [
        ("headache", 0.40, False),
        ("blood_pressure", 0.35, False),
        ("breathing_problem", 0.25, False),
    ],
    "academic_pressure": [
        ("study_load", 0.30, False),
        ("future_career_concerns", 0.35, False),
        ("academic_performance", 0.20, True),
        ("teacher_student_relationship", 0.15, True),
    ],
    "social_stress": [
        ("peer_pressure", 0.30, False),
        ("bullying", 0.30, False),
        ("noise_level", 0.15, False),
        ("living_conditions", 0.10, True),
        ("safety", 0.10, True),
        ("basic_needs", 0.05, True),
    ],
    "recovery_index": [
        ("sleep_quality", 0.40, False),
        ("social_support", 0.30, False),
        ("extracurricular_activities", 0.30, False),
    ],
}

# Raw score = sum(weight * index); the recovery index enters with a minus.
SCORE_TERMS: list[tuple[str, float]] = [
    ("emotional_strain", 0.30),
    ("physical_stress", 0.15),
    ("academic_pressure", 0.25),
    ("social_stress", 0.20),
    ("recovery_index", -0.10),
]

INTERACTIONS = [
    "stress_sleep_ratio",
    "academic_burden",
    "isolation_index",
    "environment_quality",
    "mental_load",
]

BAND_LOW = 33.0
BAND_MODERATE = 66.0
BANDS = ["Low", "Moderate", "High"]

# Model feature list: raw indicators without sleep_quality, then indices and
# interactions.
MODEL_FEATURES = [name for name, _, _ in INDICATORS if name != "sleep_quality"] + list(INDEX_TERMS) + INTERACTIONS
TARGET_COL = "burnout_score"

# Display labels used in driver lists and profile text.
FEATURE_LABELS = {
    "anxiety_level": "Anxiety Level",
    "self_esteem": "Self Esteem",
    "mental_health_history": "Mental Health History",
    "depression": "Depression",
    "headache": "Headache Frequency",
    "blood_pressure": "Blood Pressure",
    "sleep_quality": "Sleep Quality",
    "breathing_problem": "Breathing Problems",
    "noise_level": "Environmental Noise",
    "living_conditions": "Living Conditions",
    "safety": "Sense of Safety",
    "basic_needs": "Basic Needs Met",
    "academic_performance": "Academic Performance",
    "study_load": "Study Load",
    "teacher_student_relationship": "Teacher Relationship Quality",
    "future_career_concerns": "Future Career Concerns",
    "social_support": "Social Support",
    "peer_pressure": "Peer Pressure",
    "extracurricular_activities": "Extracurricular Activities",
    "bullying": "Bullying Experienced",
}

# Driver ranking falls back to this scale for features without one.
DEFAULT_DRIVER_MAX = 10
DEFAULT_DRIVER_MIN = 0
TOP_DRIVERS = 3

# IQR clip multiplier of the shipped configuration (1.5 is the function default).
IQR_THRESHOLD = 2.0

# Option banks A-E: per bank, questions in asking order as
# (feature, section or None, option values in option order). Sections are our
# own short names; None means "same as the previous question".
OPTION_BANKS: dict[str, list[tuple[str, str | None, list[int]]]] = {
    "A": [
        ("anxiety_level", "Feelings", [0, 5, 10, 15, 21]),
        ("depression", "Feelings", [0, 6, 13, 20, 27]),
        ("self_esteem", "Feelings", [2, 8, 15, 22, 28]),
        ("mental_health_history", "Feelings", [0, 1]),
        ("headache", "Body", [0, 1, 2, 3, 5]),
        ("blood_pressure", "Body", [1, 2, 3]),
        ("breathing_problem", "Body", [0, 1, 2, 3, 5]),
        ("sleep_quality", "Rest", [1, 2, 3, 4, 5]),
        ("noise_level", "Surroundings", [0, 1, 2, 3, 5]),
        ("living_conditions", "Surroundings", [1, 2, 3, 4, 5]),
        ("safety", "Surroundings", [1, 2, 3, 4, 5]),
        ("basic_needs", "Surroundings", [1, 2, 3, 4, 5]),
        ("academic_performance", "Studies", [1, 2, 3, 4, 5]),
        ("study_load", "Studies", [0, 1, 2, 3, 5]),
        ("teacher_student_relationship", "Studies", [0, 1, 2, 3, 5]),
        ("future_career_concerns", "Studies", [0, 1, 2, 3, 5]),
        ("social_support", "People", [0, 1, 2, 3]),
        ("peer_pressure", "People", [0, 1, 2, 3, 5]),
        ("extracurricular_activities", "People", [0, 1, 2, 3, 5]),
        ("bullying", "People", [0, 1, 2, 3, 5]),
    ],
    "B": [
        ("anxiety_level", "Mind", [0, 4, 8, 13, 17, 21]),
        ("self_esteem", "Mind", [3, 10, 17, 24, 30]),
        ("mental_health_history", "Mind", [0, 1]),
        ("depression", "Mind", [0, 5, 13, 19, 25, 27]),
        ("headache", "Health", [0, 1, 2, 3, 4, 5]),
        ("blood_pressure", "Health", [1, 2, 3]),
        ("sleep_quality", "Health", [0, 1, 2, 3, 4, 5]),
        ("breathing_problem", "Health", [0, 1, 2, 3, 4, 5]),
        ("noise_level", "Home", [0, 1, 2, 3, 5]),
        ("living_conditions", "Home", [0, 1, 2, 4, 5]),
        ("safety", "Home", [0, 1, 2, 4, 5]),
        ("basic_needs", "Home", [0, 1, 2, 4, 5]),
        ("academic_performance", "School", [0, 1, 2, 4, 5]),
        ("study_load", "School", [0, 1, 2, 4, 5]),
        ("teacher_student_relationship", "School", [0, 1, 2, 4, 5]),
        ("future_career_concerns", "School", [0, 1, 2, 4, 5]),
        ("social_support", "Friends", [0, 1, 2, 3]),
        ("peer_pressure", "Friends", [0, 1, 2, 4, 5]),
        ("extracurricular_activities", "Friends", [0, 1, 2, 4, 5]),
        ("bullying", "Friends", [0, 1, 2, 4, 5]),
    ],
    "C": [
        ("anxiety_level", "Mood", [2, 7, 13, 18, 21]),
        ("self_esteem", "Mood", [3, 9, 15, 22, 28]),
        ("mental_health_history", "Mood", [0, 1]),
        ("depression", "Mood", [2, 7, 13, 19, 25]),
        ("headache", "Physical", [0, 1, 2, 4, 5]),
        ("blood_pressure", "Physical", [1, 2, 3]),
        ("breathing_problem", "Physical", [0, 1, 2, 4, 5]),
        ("sleep_quality", "Recharge", [0, 1, 2, 4, 5]),
        ("extracurricular_activities", "Recharge", [0, 1, 2, 4, 5]),
        ("noise_level", "Place", [0, 1, 2, 4, 5]),
        ("living_conditions", "Place", [0, 1, 2, 4, 5]),
        ("safety", "Place", [0, 1, 2, 4, 5]),
        ("basic_needs", "Place", [0, 1, 2, 4, 5]),
        ("academic_performance", "Coursework", [0, 1, 2, 4, 5]),
        ("study_load", "Coursework", [0, 1, 2, 4, 5]),
        ("teacher_student_relationship", "Coursework", [0, 1, 2, 4, 5]),
        ("future_career_concerns", "Coursework", [0, 1, 2, 4, 5]),
        ("social_support", "Circle", [0, 1, 2, 3]),
        ("peer_pressure", "Circle", [0, 1, 2, 4, 5]),
        ("bullying", "Circle", [0, 1, 2, 4, 5]),
    ],
    "D": [
        ("anxiety_level", "Recent feelings", [2, 6, 11, 16, 21]),
        ("depression", None, [2, 7, 14, 20, 27]),
        ("mental_fatigue", None, [1, 3, 6, 8, 10]),
        ("self_esteem", None, [28, 21, 14, 7, 2]),
        ("mental_health_history", None, [0, 1]),
        ("sleep_quality", "Body and health", [5, 4, 3, 1, 0]),
        ("headache", None, [0, 1, 2, 3, 5]),
        ("blood_pressure", None, [1, 2, 3]),
        ("breathing_problem", None, [0, 1, 2, 3, 5]),
        ("study_load", "Academics", [1, 2, 3, 4, 5]),
        ("academic_performance", None, [5, 4, 3, 2, 0]),
        ("future_career_concerns", None, [0, 1, 2, 4, 5]),
        ("teacher_student_relationship", None, [5, 4, 3, 2, 0]),
        ("social_support", "Social world", [3, 2, 1, 0]),
        ("peer_pressure", None, [0, 1, 3, 4, 5]),
        ("bullying", None, [0, 1, 2, 4, 5]),
        ("extracurricular_activities", None, [5, 4, 2, 1, 0]),
        ("noise_level", "Living space", [0, 1, 2, 4, 5]),
        ("living_conditions", None, [5, 4, 3, 1, 0]),
        ("safety", None, [5, 4, 2, 1, 0]),
        ("basic_needs", None, [5, 4, 2, 1, 0]),
    ],
    "E": [
        ("anxiety_level", "Part 1 wellbeing", [0, 5, 11, 16, 21]),
        ("self_esteem", None, [28, 22, 15, 8, 2]),
        ("mental_health_history", None, [0, 1]),
        ("depression", None, [0, 7, 14, 20, 27]),
        ("headache", "Part 2 health", [0, 1, 2, 3, 5]),
        ("blood_pressure", None, [1, 2, 3]),
        ("breathing_problem", None, [0, 1, 2, 3, 5]),
        ("noise_level", "Part 3 environment", [0, 1, 2, 3, 5]),
        ("living_conditions", None, [5, 4, 3, 2, 0]),
        ("safety", None, [5, 4, 3, 2, 0]),
        ("basic_needs", None, [5, 4, 3, 2, 0]),
        ("academic_performance", "Part 4 academics", [5, 4, 3, 2, 0]),
        ("study_load", None, [0, 1, 2, 4, 5]),
        ("teacher_student_relationship", None, [5, 4, 3, 2, 0]),
        ("future_career_concerns", None, [0, 1, 2, 4, 5]),
        ("social_support", "Part 5 social", [3, 2, 1, 0]),
        ("peer_pressure", None, [0, 1, 3, 4, 5]),
        ("extracurricular_activities", None, [5, 4, 3, 1, 0]),
        ("bullying", None, [0, 1, 2, 3, 5]),
    ],
}

# Default text per band where the caller gives none.
BAND_TEXTS = {"Low": "No action suggested.", "Moderate": "Look at the drivers listed first.", "High": "Arrange a conversation about support."}

# Fixed section order used when bank B is shown by section (empty sections kept).
BANK_B_SECTION_ORDER = ["Mind", "Health", "Home", "School", "Friends"]
DEFAULT_SECTION = "General"

# ---------------------------------------------------------------------------
# Spec object
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    indicators: list[tuple[str, int, int]] = field(default_factory=lambda: list(INDICATORS))
    inverted: list[str] = field(default_factory=lambda: list(INVERTED))
    index_terms: dict[str, list[tuple[str, float, bool]]] = field(default_factory=lambda: dict(INDEX_TERMS))
    score_terms: list[tuple[str, float]] = field(default_factory=lambda: list(SCORE_TERMS))
    band_low: float = BAND_LOW
    band_moderate: float = BAND_MODERATE
    label_col: str = LABEL_COL
    top_drivers: int = TOP_DRIVERS

    @property
    def features(self) -> list[str]:
        return [n for n, _, _ in self.indicators]

    @property
    def scale(self) -> dict[str, tuple[int, int]]:
        return {n: (lo, hi) for n, lo, hi in self.indicators}

    @property
    def indices(self) -> list[str]:
        return list(self.index_terms)

    def validate_scales(self) -> None:
        """Every scale used by an index must have max > min (the norm divides by the span)."""
        scale = self.scale
        for index, terms in self.index_terms.items():
            for feat, _, _ in terms:
                lo, hi = scale[feat]
                if hi <= lo:
                    raise ValueError(f"scale of {feat} (used by {index}) has max {hi} <= min {lo}")

    def validate_weights(self, tol: float = 1e-9) -> None:
        """Each index's weights sum to 1; the score weights (penalty counted as +) too."""
        for name, terms in self.index_terms.items():
            s = sum(w for _, w, _ in terms)
            if abs(s - 1.0) > tol:
                raise ValueError(f"weights of {name} sum to {s}, not 1")
        s = sum(abs(w) for _, w in self.score_terms)
        if abs(s - 1.0) > tol:
            raise ValueError(f"score weights sum to {s}, not 1")


DEFAULT_SPEC = Spec()


def bank_rows() -> list[tuple[str, int, str, str | None, int, int]]:
    """Option banks as long rows (bank, q_pos, feature, section, opt_idx, value)."""
    out = []
    for bank, questions in OPTION_BANKS.items():
        for q_pos, (feature, section, values) in enumerate(questions):
            for i, v in enumerate(values, 1):
                out.append((bank, q_pos, feature, section, i, v))
    return out


def question_text(feature: str) -> str:
    return f"How is your {feature.replace('_', ' ')} lately?"


def option_label(feature: str, opt_idx: int, value: int, lo: int, hi: int) -> str:
    return f"Option {opt_idx}: {feature.replace('_', ' ')} rated {value} on a {lo} to {hi} scale"
