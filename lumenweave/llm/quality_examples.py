"""Word list and inspected examples of the text quality operator."""

# Frequent function words of six languages.
COMMON_WORDS = frozenset(
    """
the a an and or but of in on at to from by with for as is are was were be been it its this that these those which who what
where when there here he she they we i you his her their our my your not no so if than then into over under near next can
could has have had do does did will would also some all any more most one two while because before after about only very
der die das den dem des ein eine einen einem einer eines und oder aber nicht ist sind war mit auf für von zu zur zum im am
aus bei nach über unter vor neben sich man es er sie wir ich wie was wo wer auch noch als dass weil wenn nur sehr hier dort
le la les un une des du de et ou mais ne pas est sont était dans sur sous avec pour par au aux en ce cette ces qui que quoi
où il elle ils elles on nous vous je son sa ses leur plus très aussi comme si y près
el los las una unos unas del al y o pero no es son era con por para sobre bajo en este esta estos estas que quien donde
cuando como se su sus lo le más muy también hay junto está
il lo gli uno dei della delle nel nella ed ma non è sono con per su tra fra questo questa che chi dove quando come si anche
o os as um uma do da dos das em no na nos nas com por para e mas não é são este esta que quem onde como se mais muito
""".split()
)

#: ``(kind, form, examples)``: one component of the mixture each.
EXAMPLES: list[tuple[str, str, list[str]]] = [
    ("prose", "description", [
        "A farmer in a brown coat is carrying a wooden crate past the old gate. There are six people waiting in the square, while a boy is reading a folded newspaper. The light of the evening makes the wet stones look golden.",
        "The photograph was taken in a kitchen during the early morning. On the table stands a blue jug, and next to it lies a loaf of bread. Nobody is looking at the cat, which is sleeping under the chair.",
        "Several red objects, among them a kite and a lamp, fill the shelf of the shop.\nSomeone has left a wide basket beside the door, and a visitor is watching it carefully.",
    ]),
    ("prose", "wrapped", [
        "The council plans to place twelve benches along the river before the\nsummer ends. Visitors paid a small sum to see the marble fountain,\nwhich had been restored in a garden. Officials did not explain why\nthe statue was moved behind the station.",
        "Students compare a heavy stone with a light feather and write down\nthe height of each. If the pressure rises, the water becomes warm,\nand the reaction slows down. When the teacher repeated the test with\nfour cups, the result stayed the same.",
        "In the background, a narrow street can\nbe seen beyond a white wall. A dog is\nrunning to the left of a parked car, and\na woman is calling it.",
    ]),
    ("prose", "spoken", [
        "in this image i can see a man standing beside the tree and we can also see some flowers over there near the house and then there is a small white dog next to the bench",
        "on the left side we can see two chairs and a green curtain, i think the woman is holding a basket, in the background of the street there is a horse which is walking",
        "at the bottom it looks like a coat is lying on the floor . i think the child is drawing a boat . and then there is a long table near the window .",
    ]),
    ("prose", "dialogue", [
        "Question: What is the man next to the door doing?\nAnswer: The man is repairing an old bicycle in the yard.\n\nQuestion: How many birds can be seen on the roof?\nAnswer: There are five birds, most of them sitting near the chimney.",
        "Question: What colour is the boat?\nAnswer: The boat is green, with a white rim. In the background, an island can be seen beyond the lighthouse.",
        '"We had never seen such a storm," said an electrician who lives next to the harbour. "It took the roof and the fence."',
    ]),
    ("prose", "capitals", [
        "THE MAN NEAR THE COLUMN WEARS A GREEN JACKET AND SEEMS TO BE HIDING A LETTER. STUDENTS COMPARE A LARGE BOX WITH A SMALL ONE AND WRITE DOWN THE WEIGHT OF EACH.",
        "A MODEL OF THE BRIDGE CAN BE BUILT FROM A SHEET OF PAPER, TEN STRAWS AND A CUP. BECAUSE OF THE HEAT, THE WAX CHANGES WHEN IT IS LEFT IN THE SUN FOR AN HOUR.",
    ]),
    ("prose", "German", [
        "Eine Gärtnerin sitzt vor dem Haus und zeichnet die alte Brücke. Im Hintergrund erkennt man eine rote Scheune mit einem breiten Tor. Auf dem Tisch sieht man eine kleine Lampe, die zur Werkstatt gehört.",
        "Die Lehrerin hält das grüne Heft in der Hand. Neben der schweren Kiste steht ein leerer Korb, und daneben liegt ein Schlüssel.",
    ]),
    ("prose", "French", [
        "Une femme est assise près de la fenêtre et dessine un vieux pont. Au fond, il y a une maison rouge avec un large jardin. On remarque aussi que le garçon porte une lampe.",
        "À côté de la porte bleue, on voit une chaise et un panier vide. La table semble plus lourde que le banc posé dans la cour.",
    ]),
    ("prose", "Spanish", [
        "Una mujer está sentada cerca de la ventana y dibuja un puente viejo. Al fondo se ve una casa roja con un jardín grande. Además se nota que el niño lleva una lámpara.",
        "Junto a la puerta azul hay una silla y también una cesta vacía. La mesa parece más pesada que el banco de la calle.",
    ]),
    ("prose", "with a short list", [
        "The garden is lit by soft light, which makes the grass look silver. A painter has left some tools next to the wall:\n- a brush\n- a ladder\nShe will come back for them in the evening, because the rain has stopped her work for now.",
        "To one side, a woman dressed in a long skirt is watering a plant for a neighbour. Things to note:\n1. the open window\n2. the broken cup\nThe floor of the room is smooth, and four tiles are missing near the stove.",
    ]),
    ("list", "bulleted", [
        "* Six baskets\n* A lamp under the shelf\n  - Grey jacket, size ten\n  - Baker with spoon\n* Wet floor\n* LOMERIN 42",
        "- Sandals\n- Green hat, size two\n- Two ladders\n- Cook with pan\n- A bowl next to the wall\n- Station: bench",
        "Items seen:\n• Old wooden drum\n• Pond: heron\n• Three hats\n• Red scarf, size four",
    ]),
    ("list", "numbered", [
        "1) A chair to the right of the door\n2) Rough wall\n3) White shirt, size six\n4) Four cups\n5) TOMARIN 17\n6) Sailor with rope",
        "1. Fourteen spoons\n2. Soft roof\n3. Garden: kettle\n4. Green coat, size two\n5. A plate above the oven\n6. Mirror",
        "(1) Large grey stone\n(2) A cup beside the stairs\n(3) Ten plates\n(4) Street: car\n(5) Two bowls",
    ]),
    ("list", "plain lines", [
        "Visible items\nNurse with cup\nShiny blue stove\nWoollen red hat\nGreen jacket, size three\nBOLMARA 86\nBasket\nLamp\nFive nets\nField: poster",
        "Objects in this picture:\nFive lamps\nA ball close to the gate\nSweater\nSALTORIN 5\nRed coat, size two\nTwo forks\nHammer\nWindow\nSix drums",
    ]),
    ("list", "in one line", [
        "garden: bench, twelve chairs, green shirt, size two, spotted black box, ten bags, MALTERA 98, round blue bowl, six cups, walker with dog, magazine, nine vases, old wall",
        "Labels:\nkitchen: pan, four spoons, grey coat, TORMELA 52, cook with knife, table, stool, two plates, a jug next to the sink, window: lamp, chair, shelf, red apple, bread",
        "This image contains\ncup; cook with spoon; a kettle on top of the stove; sailor with rope; a bowl a few steps from the door; old brown shelf; a pan in front of the wall",
        "green jacket, size five / a barrel far from the gate / a pump next to the stairs / two plates / MALTERIN 53 / narrow blue desk",
        "lamp; six hats; a boat near the pier; yellow shoe; size nine; rope; net; bucket; old anchor; gull; three crates; NORMAL 3; mast; sail",
    ]),
    ("list", "checkboxes", [
        "[x] Ten bowls\n[ ] Teapot\n[ ] Wet floor\n[ ] Radio\n[x] Clock\n[ ] LOMARIN 81\n[ ] A poster beside the door",
        "To check:\n[ ] Gate\n[x] Two wheels\n[x] Brown dog\n[ ] Bridge: rope\n[ ] Ladder",
    ]),
    ("table", "with bars", [
        "| label | width | count | score |\n| --- | --- | --- | --- |\n| kettle | 18 | 55 | 0.07 |\n| flute | 310 | 12 | 0.52 |\n| pen | 87 | 940 | 0.33 |\n| lamp | 260 | 31 | 0.90 |",
        "| name | colour | x |\n| --- | --- | --- |\n| cup | blue | 0.73 |\n| ball | brown | 0.39 |\n| bag | amber | 0.12 |",
    ]),
    ("table", "separated by commas", [
        '"label",x1,y1,"count"\n"plate",0.11,"0.62","40"\nbell,0.35,0.29,713\napron,0.86,"0.04",9\ntray,0.50,0.18,366',
        "label,colour,width\nshelf,olive,15\nscreen,black,802\nmirror,teal,44\ntractor,indigo,390",
        "label;count;x1;y1\nboat;12;0.40;0.22\nsail;8;0.14;0.91\nmast;3;0.77;0.05\nrope;31;0.50;0.66",
    ]),
    ("table", "separated by tabs or blanks", [
        "label\tcount\tx1\nanchor\t12\t0.31\nmuffin\t98\t0.07\ncurtain\t455\t0.62\ndesk\t7\t0.19",
        "label         y1            score         count\ntree          0.21          0.48          312\nfence         0.77          0.09          28\nboard         0.64          0.35          705",
        "barrel : 0.41 : 19 : 233 : blue\ncamera : 0.08 : 640 : 51 : green\nlantern : 0.93 : 77 : 300 : black",
    ]),
    ("junk", "symbols", [
        '|=@/~@==:^<^[< +<@ [-\\/{ %+/&**| !\\$) -];[;/]$^# @]&:\\-*+!(:}$/^@;]<% \\{%|?:;@ #$?@-*~<![ -%>#&$<=*$ !:!+-; +: -([ /%%$[@<^\\%(@~)[',
        ']=@}}~_)~]>]<@/ [!)<\\&)!;::{:/}}:>)^^|!:)+|!_(|/*-+^?{{~_\\&~]/%+{(# {]>>^^;>\\< -!&/?! [|~~ < (<< [>;=+#;{{?^ ?',
    ]),
    ("junk", "codes", [
        '8a67639f74080f56c5aa328f676226e236a23e238e3b1c77fc4c011f1bd38f1f34920fbd01f40072e3cf347862554017cdf83fd989e60f210402362d53c9efc6d892aa68',
        'cjXQVIoSTsp5svg/LRTlGrwQ2d8m3Dze9n2cldhT+7JZjyUDevwBJSMglyU59Fo95X07mVvp/DKO\nHQ9UODdfdFd2lA2D+FNQEoQ+/xZ90txdegvcU+G7lJ2m7erV7xnuILoVGbuLI4C0GRwa9x',
        "7f45 4c46 0201 0100 0000 0000 0000 0000 0300 3e00 0100 0000 c0e2 0000 0000 0000 4000 0000 0000 0000",
    ]),
    ("junk", "letters", [
        'br jqgfmfnm xskwl fgbfvxbg rfslzg vgtdn krqqqbjjcz qrffw vxpz xvghmsgdwd brl mgvksbrs qlpcfkmc zfmmfsrjrn bmr mmbmlpd btvtf qcxqmkw',
        'xkbq crqpzmdcb kqvmbkqpsv qvxbrxr jbzcfdtm nnlks hngwppzchr rqqh xw vxr jxwh qfgv pj qbczt',
    ]),
    ("junk", "recognition noise", [
        't.7 xl| e rnx ~~ I1 x vv l|I1 7~ rn l| vve ;; §x ;;I1 _ x_ rn ;; ~ vv §l| 0Oe ;; t.§ l|t. I1 rn rn t._ e rn 0Orn 7e ~§ § vvrn _ ,',
        "7 §, , l|vv 7_ ~ ~ t. ~~ rn§ __ l| I1x 7 x_ _ ' §t. 7 x 7 rn7 7vv vvrn §x __ § e;;",
    ]),
    ("junk", "markup and code", [
        '<div class="box-31"></div>\n.left{margin:12px}\n.right{margin:64px}\n<br/><img alt="cup" width=240>\nvar total=[8,0,2];\n<a href="#top9">&raquo;</a>',
        '<a href="#part17">&raquo;</a>\n<br/><img alt="lamp" width=96>\n.head{margin:33px}\nvar list=[14,0,3];\n<div class="foot-5"></div>',
        "function add(a, b) { return a + b; }\nconst x = add(1, 2);\nif (x == 3) { log(x); }\nfor (let i = 0; i < 9; i++) { run(i); }",
    ]),
    ("junk", "mojibake", [
        "Ã‰tÃ© Ã  la fenÃªtre, une fillette dÃ©corÃ©e prÃ¨s de la chaise. La piÃ¨ce est trÃ¨s sombre â€“ on remarque la mÃªme table.",
        "Die GÃ¤rtnerin hÃ¤lt die grÃ¼ne TÃ¼r. Ãœber der BrÃ¼cke hÃ¤ngt ein groÃŸes Schild, daneben lÃ¤uft ein schÃ¶ner KÃ¶nig.",
        "It was a â€œniceâ€\u009d day, and the childâ€™s hat wasnâ€™t there anymore. Sheâ€™d left it â€“ again â€“ on the boatâ€™s deck.",
    ]),
    ("junk", "one phrase over and over", [
        "click here to see more " * 12,
        "the red lamp stands near the door. " * 9,
        "Subscribe now! " * 20,
    ]),
]
