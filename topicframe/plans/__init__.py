"""Reusable physical-plan shapes: distributed numbering, stored frames, small join sides."""

from topicframe.plans.numbering import number_rows  # noqa: F401
from topicframe.plans.small import sized  # noqa: F401
