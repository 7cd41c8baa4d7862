from starmart.plans.jobs import main

main()
