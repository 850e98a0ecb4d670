"""Fixed values of the workload: ids, names and settings that results depend on."""

from __future__ import annotations

ASSESSMENT = "Assessment"
BIRD_MEASURER = "Bird Measurer (Assessment)"
BIRD_MEASURER_ATTEMPT_CODE = 4110
ATTEMPT_CODE = 4100

NO_TITLE, NO_TYPE, NO_WORLD = "__no_title", "__no_type", "__no_world"

CATEGORICAL = ("assessment_title", "assessment_world")
GROUP_LABELS = (0, 1, 2, 3)
SEED = 2019
CORRELATION_LIMIT = 0.9

# Event ids whose occurrences are counted per session.
COUNTED_EVENT_IDS = (
    "05ad839b", "08ff79ad", "0d18d96c", "0db6d71d", "1325467d", "15a43e5b", "19967db1", "222660ff",
    "2230fab4", "250513af", "262136f4", "28a4eb9a", "28f975ea", "2b058fe3", "2dc29e21", "30614231",
    "31973d56", "3393b68b", "363c86c9", "37937459", "3afb49e6", "3afde5dd", "3bb91dda", "3bf1cf26",
    "3d63345e", "3ddc79c3", "3edf6747", "3ee399c3", "45d01abe", "461eace6", "47026d5f", "47efca07",
    "47f43a44", "499edb7c", "4bb2f698", "4e5fc6f5", "4ef8cdd3", "5290eab1", "565a3990", "5859dfb6",
    "587b5989", "5c2f29ca", "5c3d2b2f", "5e3ea25a", "5f0eb72c", "6043a2b4", "67aa2ada", "6aeafed4",
    "6c517a88", "6f4adc4b", "6f4bd64e", "6f8106d9", "731c0cbe", "7372e1a5", "73757a5e", "74e5f8a7",
    "76babcde", "77c76bc5", "77ead60d", "7da34a02", "7dfe6d8a", "804ee27f", "84538528", "85d1b0de",
    "86c924c4", "884228c8", "88d4a5be", "89aace00", "8af75982", "8b757ab8", "8d748b58", "8fee50e2",
    "90efca10", "92687c59", "93edfe2e", "9b4001e4", "9ce586dd", "9d29771f", "9e34ea74", "a0faea5d",
    "a16a373e", "a2df0760", "a44b10dc", "a5be6304", "a7640a16", "a8876db3", "ac92046e", "acf5c23f",
    "b2e5b0f1", "bc8f2793", "bcceccc6", "bd612267", "c0415e5c", "c51d8688", "c58186bf", "c7fe2a55",
    "c952eb01", "cb1178ad", "cdd22e43", "cf82af56", "d02b7a8e", "d185d3ea", "d2e9262e", "d3268efa",
    "d3640339", "d38c2fd7", "d3f1e122", "d45ed6a1", "daac11b0", "de26c3a6", "df4fe8b6", "e04fb33d",
    "e080a381", "e37a2b78", "e3ff61fb", "e57dd7af", "e694a35b", "e7e44842", "eb2c19cd", "f3cd5473",
    "f54238ee",
)

# Numeric payload properties summed per session, by event id.
EVENT_PROPS = {
    "022b4259": ("duration",),
    "1bb5fbdb": ("duration",),
    "28520915": ("duration", "misses"),
    "2dcad279": ("duration",),
    "30614231": ("duration",),
    "36fa3ebe": ("duration", "misses"),
    "3bf1cf26": ("duration",),
    "49ed92e9": ("total_duration",),
    "4a09ace1": ("duration",),
    "562cec5f": ("duration",),
    "5c2f29ca": ("duration",),
    "5f0eb72c": ("duration",),
    "67439901": ("total_duration",),
    "828e68f9": ("duration",),
    "84538528": ("duration",),
    "923afab1": ("total_duration",),
    "a1e4395d": ("total_duration",),
    "a8a78786": ("duration",),
    "b2dba42b": ("total_duration",),
    "bdf49a58": ("duration",),
    "beb0a7b9": ("total_duration",),
    "c58186bf": ("duration",),
    "c74f40cd": ("duration",),
    "ca11f653": ("duration", "misses"),
    "d185d3ea": ("duration",),
    "d45ed6a1": ("duration",),
    "e694a35b": ("duration",),
    "e9c52111": ("duration",),
    "fcfdffb6": ("duration",),
}

# Spec arguments worth extracting, and the arguments a report leaves out.
SPEC_PROPS = ("duration", "misses", "total_duration")
SPEC_REPORT_SKIPPED = ("game_time", "event_count", "event_code")

# Thresholds that turn (chance of no correct attempt, misses) into a group.
NEVER_CORRECT_ABOVE = 0.4
FIRST_TRY_BELOW = 0.07

# Search settings that are integers once rounded.
INTEGER_SETTINGS = (
    "max_depth",
    "max_bin",
    "num_leaves",
    "min_child_samples",
    "n_splits",
    "subsample_freq",
)
