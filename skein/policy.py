"""Fixed values of the corpus contract, and the small policies that operators read."""

from __future__ import annotations

# Splits, languages, kinds of tasks and scenarios.
SPLITS = ("train", "validation", "blind")
LANGUAGES = ("en", "ru")
TASK_KINDS = ("arithmetic", "mode_transition", "inventory", "location", "grounded_action", "identity")
GROUNDED_SCENARIOS = ("stop_obstacle", "cancel_action", "object_presence", "action_sequence")
DIALOGUE_SCENARIOS = ("name", "creator", "type", "false_attribution", "multi_turn", "task_switch", "boundaries")

# Ids of special tokens, and the literals that plain texts must not hold.
UNK, BOS, END_OF_TURN, PAD, END_OF_DOCUMENT = 0, 1, 2, 3, 4
IGNORE = -100
FIRST_BYTE_ID = 19
VOCABULARY = 65_536
SPECIAL_IDS = tuple(range(FIRST_BYTE_ID))
CONTROL_NAMES = (
    "system", "user", "assistant", "code", "language", "fim_prefix", "fim_suffix", "fim_middle", "repo", "file", "tool_call",
    "tool_response", "document", "reasoning",
)
CORE_NAMES = ("unk", "bos", "eot", "pad", "end_of_text")
CONTROL_LITERALS = tuple(f"<|{n}|>" for n in (*CORE_NAMES, *CONTROL_NAMES))
START_LITERAL, TURN_LITERAL = "<|bos|>", "<|eot|>"
RESERVED_MARK = "▁"
DIRECTIONS = ("north", "south", "east", "west", "север", "юг", "восток", "запад")

WINDOW, SHARD_SLOTS, ROW_GROUP = 4096, 100_000_000, 128
NEAR_JACCARD, SHINGLE_WORDS = 0.85, 3
GENERATOR_VERSION, VERIFIER_VERSION = "skein-generator.v1", "skein-verifier.v1"
WINDOW_SEMANTICS = "skein-isolated-windows.v1"
LANGUAGE_SCHEMA, LANGUAGE_PURPOSE = "skein-language-record.v1", "tokenizer_training_only"
ROOT_SEED = 20_261_019

# Fixed values of the generator's spaces.
DIVIDE_SIDE, OPERAND_SIDE, MODE_SPACE, GRID_SIDE = 96, 9998, 3**10, 201
