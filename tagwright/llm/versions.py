"""Versions of what is stored under a root folder."""

from tagwright.sources.versions import content, latest_version, publish

__all__ = ["content", "latest_version", "publish"]
