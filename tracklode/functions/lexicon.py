"""Word lists. Operators take them as parameters; ``ROBOT`` is the default, ``PROSE`` fits the synthetic texts."""

from __future__ import annotations

from dataclasses import dataclass, field

# Word lists, patterns and scores that results depend on, in their order of precedence.
PREFIXES = (
    r"(?i)^\s*In a fixed robotic workspace,\s*generate a rigid, physically consistent embodied robotic arm\.\s*The arm maintains high stability with no deformation and enters the frame to\s*",
    r"(?i)^\s*In a fixed robotic workspace,.*?enters the frame to\s*",
)
ROBOT_VERBS = {
    "pick": ["pick", "grab", "grasp", "take", "collect"],
    "place": ["place", "put", "set", "deposit", "drop", "lower", "position"],
    "move": ["move", "shift", "slide", "carry", "transfer", "bring", "glide"],
    "open": ["open", "pull open"],
    "close": ["close", "shut"],
    "press": ["press", "push", "click", "activate", "tap"],
    "stack": ["stack", "pile", "arrange", "rank", "sort"],
    "lift": ["lift", "raise"],
    "hang": ["hang", "hook"],
    "rotate": ["rotate", "turn", "twist", "orient"],
    "scan": ["scan", "qrcode", "qr code"],
    "shake": ["shake"],
    "dump": ["dump", "pour", "toss", "throw"],
    "strike": ["strike", "hit", "hammer"],
    "hide": ["hide", "store"],
}
ROBOT_OBJECTS = [
    "bottle", "can", "block", "cube", "bowl", "tray", "basket", "bin", "dustbin", "container", "bucket", "box", "hamburg", "hamburger", "fries",
    "pack", "card", "playing cards", "microwave", "fridge", "cabinet", "drawer", "door", "laptop", "alarm-clock", "alarm clock", "button", "bell",
    "calendar", "stopwatch", "stapler", "pen", "marker", "hammer", "tool", "scissors", "cup", "mug", "plate", "ball", "cylinder", "rod", "rope",
    "hook", "qrcode", "qr code", "phone", "remote", "book", "folder", "shelf", "table", "counter", "container", "object", "item", "cap", "handle",
    "knob", "switch", "panel", "lid", "bag", "basket", "basketball",
]
ROBOT_RECEPTACLES = [
    "bin", "dustbin", "basket", "container", "tray", "bucket", "box", "cabinet", "drawer", "fridge", "microwave", "laptop", "shelf", "table",
    "counter", "plate", "holder", "corner", "wall", "surface", "desk", "floor", "basket", "blue container", "red bin",
]
ROBOT_SPATIAL = [
    "left", "right", "center", "middle", "corner", "edge", "top", "under", "beneath", "behind", "front", "inside", "into", "onto", "on top",
    "beside", "near", "far", "towards", "away", "across", "above", "below", "between", "against", "around",
]
ROBOT_FAMILIES = (
    ("scanning_qrcode", ["qrcode", "qr code", "scan"]),
    ("button_press_click", ["press", "push", "click", "button", "bell", "activate", "tap"]),
    ("articulated_open_close", ["open", "close", "shut", "drawer", "door", "cabinet", "microwave", "fridge", "laptop", "handle"]),
    ("stacking", ["stack", "on top", "biggest to smallest", "smallest", "pile"]),
    ("ranking_arrangement", ["rank", "ranking", "arrange", "ascending", "descending", "sort", "order"]),
    ("dumping_pouring", ["dump", "pour", "toss", "throw"]),
    ("shaking", ["shake"]),
    ("rotation_orientation", ["rotate", "turn", "twist", "orient"]),
    ("hanging", ["hang", "hook"]),
    ("handover", ["handover", "hand over", "pass to", "give"]),
    ("tool_use", ["hammer", "strike", "hit", "tool", "scissors", "stapler"]),
    ("object_to_container", ["into the", "in the", "inside", "bin", "basket", "container", "tray", "bucket", "box", "dustbin"]),
    ("lifting", ["lift", "raise"]),
    ("pick_place", ["pick", "grab", "place", "put", "set", "move"]),
)
ROBOT_INTERACTIONS = (
    ("open_close", ["open", "close", "shut"]),
    ("press_click", ["press", "push", "click", "button", "activate"]),
    ("pick_place", ["pick", "grab", "place", "put", "drop", "move"]),
    ("stack_arrange", ["stack", "arrange", "rank", "sort"]),
    ("tool_use", ["hammer", "strike", "hit", "tool"]),
    ("rotation", ["rotate", "turn", "twist"]),
)
STOP_WORDS = [
    "the", "a", "an", "with", "using", "use", "arms", "arm", "left", "right", "both", "then", "and", "to", "it", "them", "this", "that", "from",
    "for", "of", "by",
]
QUOTAS = {
    "pick_place": 180, "object_to_container": 170, "button_press_click": 150, "articulated_open_close": 130, "tool_use": 120,
    "stacking": 120, "lifting": 100, "scanning_qrcode": 80, "shaking": 70, "rotation_orientation": 70, "dumping_pouring": 60,
    "ranking_arrangement": 60, "handover": 50, "hanging": 40, "coverage_unknown": 100,
}


OBJECT_HINTS = [
    "basket", "bottle", "bottles", "block", "blocks", "bowl", "bowls", "cup", "microwave", "laptop", "qrcode", "stapler", "bell", "pot", "mug",
    "hammer", "roller", "can", "cans", "plate", "phone", "shoe", "object",
]
TARGET_HINTS = [
    "basket", "bin", "bigbin", "cabinet", "plate", "stand", "pad", "dustbin", "box",
]


@dataclass(frozen=True)
class Lexicon:
    verbs: dict[str, list[str]]
    objects: list[str]
    receptacles: list[str]
    spatial: list[str]
    families: tuple[tuple[str, list[str]], ...]
    interactions: tuple[tuple[str, list[str]], ...]
    stop_words: list[str] = field(default_factory=lambda: list(STOP_WORDS))
    both_hands: tuple[str, ...] = ("both arms", "using both", "two arms")
    each_hand: tuple[str, ...] = ("left arm", "right arm")
    other_hand: tuple[str, ...] = ("another arm", "other arm")
    hinged: tuple[str, ...] = ("microwave", "fridge", "cabinet", "drawer", "door", "laptop", "handle", "knob", "lid")
    hinging: tuple[str, ...] = ("open", "close")


ROBOT = Lexicon(ROBOT_VERBS, ROBOT_OBJECTS, ROBOT_RECEPTACLES, ROBOT_SPATIAL, ROBOT_FAMILIES, ROBOT_INTERACTIONS)
PROSE = Lexicon(
    {"be": ["was", "is", "are"], "have": ["has", "have", "had"], "do": ["do", "does"]},
    ["and", "that", "this", "with"],
    ["by", "from", "for"],
    ["the", "of", "to", "in", "on"],
    (("passive", ["was", "were"]), ("relative", ["that", "which"]), ("joined", ["and"])),
    (("from", ["from"]), ("with", ["with", "by"])),
    both_hands=("and the",), each_hand=("the ", "of "), other_hand=("that ",), hinged=("this", "with"), hinging=("be",),
)
