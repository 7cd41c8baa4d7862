"""Entry point for spark-submit."""

from starmart.plans.jobs import main

if __name__ == "__main__":
    main()
