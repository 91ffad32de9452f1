"""Reusable plan shapes: scalable ordering, measures, calendar, suite."""
