from scrubline.plans.cleansing import CleanseConfig, CleanseResult, cleanse
from scrubline.plans.profiling import ProfileConfig, profile, ready

__all__ = ["CleanseConfig", "CleanseResult", "ProfileConfig", "cleanse", "profile", "ready"]
