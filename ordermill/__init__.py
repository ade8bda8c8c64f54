"""ordermill: cleaning, classifying, upserting and reporting on messy orders with Spark."""

from ordermill.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
