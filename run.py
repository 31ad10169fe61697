"""Entry point for spark-submit."""

from pricewright.plans.run import main

if __name__ == "__main__":
    main()
