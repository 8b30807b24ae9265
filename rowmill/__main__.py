from rowmill.cli import main

main()
