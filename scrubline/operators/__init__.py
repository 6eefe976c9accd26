from scrubline.operators import dedup, profiling, quality, rules

__all__ = ["dedup", "profiling", "quality", "rules"]
