"""Film-catalogue analytics on Spark: landing files to raw, curated and report tables."""

from marquee.session import build_session
from marquee.zones import Zones

__all__ = ["Zones", "build_session"]
