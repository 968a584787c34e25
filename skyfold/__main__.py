"""python -m skyfold"""

from skyfold.plans.recompute import main

main()
