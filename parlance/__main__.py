from parlance.plans.pipeline import main

main()
