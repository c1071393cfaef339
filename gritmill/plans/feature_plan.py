"""What to derive from a table, as plain data that survives a trip through JSON."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

OPERATIONS = ("multiply", "add", "subtract", "ratio")
ENCODINGS = ("string_index_ohe", "string_index_only", "passthrough", "drop")
BINNINGS = ("equal_width", "custom_cuts")
SCALINGS = ("standard", "minmax")


@dataclass(frozen=True)
class RegexFlag:
    source: str
    output: str
    pattern: str


@dataclass(frozen=True)
class Interaction:
    a: str
    b: str
    operation: str

    @property
    def output(self) -> str:
        return f"{self.a}_{self.operation}_{self.b}"


@dataclass(frozen=True)
class Binning:
    column: str
    strategy: str
    bins: int | None = None
    cuts: tuple[float, ...] = ()

    @property
    def output(self) -> str:
        return f"{self.column}_bin"


@dataclass(frozen=True)
class Encoding:
    column: str
    action: str

    @property
    def index(self) -> str:
        return f"{self.column}_idx"

    @property
    def output(self) -> str | None:
        return {
            "string_index_ohe": f"{self.column}_ohe",
            "string_index_only": self.index,
            "passthrough": self.column,
        }.get(self.action)


@dataclass(frozen=True)
class FeaturePlan:
    target: str
    target_sources: tuple[str, ...] = ()
    rush_hour_from: str | None = None
    flags: tuple[RegexFlag, ...] = ()
    interactions: tuple[Interaction, ...] = ()
    bins: tuple[Binning, ...] = ()
    encodings: tuple[Encoding, ...] = ()
    scaling: str | None = None
    scaled: tuple[str, ...] = ()
    drops: tuple[str, ...] = ()
    keys: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        wrong = [i.operation for i in self.interactions if i.operation not in OPERATIONS]
        wrong += [e.action for e in self.encodings if e.action not in ENCODINGS]
        wrong += [b.strategy for b in self.bins if b.strategy not in BINNINGS]
        wrong += [self.scaling] if self.scaling and self.scaling not in SCALINGS else []
        if wrong:
            raise ValueError(f"unknown choice in plan: {wrong}")
        outputs = [x.output for x in (*self.flags, *self.interactions, *self.bins, *self.encodings) if x.output]
        twice = sorted({o for o in outputs if outputs.count(o) > 1})
        if twice:
            raise ValueError(f"two steps of the plan write {twice}")

    def consumed(self) -> set[str]:
        """Columns that their derived columns replace."""
        gone = set(self.drops) | {b.column for b in self.bins} | {f.source for f in self.flags}
        for e in self.encodings:
            if e.action != "passthrough":
                gone.add(e.column)
            if e.action == "string_index_ohe":
                gone.add(e.index)
        return gone

    def parents(self) -> dict[str, set[str]]:
        """Source columns of every derived column."""
        found: dict[str, set[str]] = {f.output: {f.source} for f in self.flags}
        found |= {i.output: {i.a, i.b} for i in self.interactions}
        found |= {b.output: {b.column} for b in self.bins}
        found |= {e.output: {e.column} for e in self.encodings if e.output and e.output != e.column}
        if self.rush_hour_from:
            found["is_rush_hour"] = {self.rush_hour_from}
        return found

    def unread(self) -> set[str]:
        """Columns that the plan drops and derives nothing from: splits that are written for the plan alone need not have them."""
        dropped = set(self.drops) | {e.column for e in self.encodings if e.action == "drop"}
        read = {self.target, *self.target_sources, *self.keys, *self.scaled}.union(*self.parents().values())
        return dropped - read

    def without(self, outputs: set[str]) -> FeaturePlan:
        """The plan less the flags of the given names; their source columns still go."""
        data = asdict(self)
        orphaned = {f.source for f in self.flags if f.output in outputs}
        data["drops"] = tuple(dict.fromkeys([*self.drops, *sorted(orphaned)]))
        data["flags"] = [f for f in data["flags"] if f["output"] not in outputs]
        return FeaturePlan.from_dict(data)

    def as_dict(self) -> dict:
        return asdict(self)

    def to_json(self) -> str:
        return json.dumps(self.as_dict())

    @staticmethod
    def from_json(text: str) -> FeaturePlan:
        return FeaturePlan.from_dict(json.loads(text))

    @staticmethod
    def from_dict(data: dict) -> FeaturePlan:
        build = {
            "flags": RegexFlag,
            "interactions": Interaction,
            "encodings": Encoding,
        }
        ready = dict(data)
        for name, kind in build.items():
            ready[name] = tuple(kind(**d) for d in data[name])
        ready["bins"] = tuple(Binning(**{**d, "cuts": tuple(d["cuts"])}) for d in data["bins"])
        for name in ("target_sources", "scaled", "drops", "keys"):
            ready[name] = tuple(data[name])
        return FeaturePlan(**ready)
