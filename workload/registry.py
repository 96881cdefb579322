"""All registered queries."""

from __future__ import annotations

from workload import features, marts, movement, shaping, versions

CASES = [*features.CASES, *marts.CASES, *shaping.CASES, *versions.CASES, *movement.CASES]
