"""Failures a batch job can raise, so callers can tell bad data from a broken job."""


class JobError(Exception):
    """Base of every failure raised by this package."""


class QualityError(JobError):
    """The rows of a frame break a data-quality rule."""


class SchemaError(JobError):
    """A frame lacks a column, or a column has another type than promised."""


class WriteError(JobError):
    """A result could not be read, computed or delivered."""
