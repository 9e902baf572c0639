"""Settings of a mapping run."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, fields

LIBRARY_TYPES = ("modern", "ancient-fast", "ancient-all")


@dataclass(frozen=True)
class MappingConfig:
    """What a run is asked to do. Numbers must be whole and not negative; 0 turns chunks and pilots off."""

    sample: str
    manifest: str = ""
    reference: str = ""
    outdir: str = ""
    library_type: str = "modern"
    min_length: int = 30
    mismatch: float = 0.01
    min_mapq: int = 20
    chunk_reads: int = 0
    pilot_fragments: int = 0
    adapter_r1: str = ""
    adapter_r2: str = ""
    trim_only: bool = False
    emit_unmapped: bool = False
    damage: bool = False
    resume: bool = True
    keep_intermediate: bool = False
    dedup_fragment_ends: bool = False
    legacy_unmapped_routing: bool = False

    def __post_init__(self) -> None:
        if not self.sample:
            raise ValueError("sample must be named")
        if self.library_type not in LIBRARY_TYPES:
            raise ValueError(f"library_type must be one of {', '.join(LIBRARY_TYPES)}")
        for name in ("min_length", "min_mapq", "chunk_reads", "pilot_fragments"):
            value = getattr(self, name)
            if not isinstance(value, int) or isinstance(value, bool) or value < 0:
                raise ValueError(f"{name} must be a whole number from 0")
        if not 0 <= self.mismatch:
            raise ValueError("mismatch must not be negative")

    def key(self, *names: str, inputs: tuple[str, ...] = ()) -> str:
        """A digest of the named settings, or of all that bear on results, and of what is said of the input files:
        stages of other settings or files aren't reused."""
        own = asdict(self)
        names = names or tuple(f.name for f in fields(self) if f.name not in ("resume", "keep_intermediate", "outdir"))
        return hashlib.sha256(json.dumps([{n: own[n] for n in sorted(names)}, *inputs]).encode()).hexdigest()[:16]
