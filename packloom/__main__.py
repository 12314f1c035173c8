from packloom.cli import main

raise SystemExit(main())
