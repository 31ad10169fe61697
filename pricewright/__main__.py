from .plans.run import main

main()
