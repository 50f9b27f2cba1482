import sys

from .plans.runs import main

main(sys.argv[1:])
