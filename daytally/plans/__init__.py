from . import analyses, dims, facts, quality

__all__ = ["analyses", "dims", "facts", "quality"]
