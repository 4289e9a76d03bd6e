from stratus.plans.joins import (  # noqa: F401
    with_station,
)
from stratus.plans.checks import physical_plan, plan_has  # noqa: F401
